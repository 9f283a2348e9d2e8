"""Continuous apply: every micro-batch is folded and merged like a batch.

The target table is the state.  The checkpoint gives at-least-once delivery; the
offsets recorded with each published batch drop what was applied before, so a
restart changes nothing twice.  Dropping by offset needs a source that hands out
the offsets of a topic partition in order, as a partitioned log does.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidefold.model import LOG_POSITION
from tidefold.operators.audit import ingest_rate
from tidefold.operators.merge import after_offsets
from tidefold.operators.scan import order_times
from tidefold.sinks.bucket_table import BucketTable, Merge, Resolve

TOGETHER = 4  # targets whose jobs share the cluster
DEALT_ROWS = 100_000  # records that one task decodes and folds

# folded changes of a batch of log records
Fold = Callable[[DataFrame], DataFrame]


def dealt(log: DataFrame) -> DataFrame:
    """The records, by log position in tasks of `DEALT_ROWS` where a split holds more: a file of small records is one split."""
    splits = log.groupBy(F.spark_partition_id().alias("split")).count()
    most, rows = splits.agg(F.max("count"), F.sum("count")).first()
    return log.repartition(ceil(rows / DEALT_ROWS), *LOG_POSITION) if (most or 0) > DEALT_ROWS else log


def apply_batch(
    table: BucketTable, log: DataFrame, fold: Fold, merge: Merge, batch: int, fence: bool = True, source: str = "",
    resolve: Resolve | None = None, by_time: bool = False, deal: bool = True,
) -> None:
    """Apply one batch of log records to a table; `source` names the checkpoint that counts the batches.

    With `by_time` records of several topics are ordered by their times, else by their offsets.  With `deal`
    records of large splits are dealt to more tasks, before they are decoded and folded.
    """
    seen = table.offsets() if fence else None
    if seen is not None:
        log = after_offsets(log, seen, seen.count())
    if fence and deal:
        log = dealt(log)
    if by_time:
        log = order_times(log, table.offsets())
    table.apply(fold(log), merge, batch, log if fence else None, source, resolve)


def apply_targets(
    tables: Mapping[str, BucketTable], log: DataFrame, plans: Mapping[str, tuple[Fold, Merge]], batch: int,
    fence: bool = True, source: str = "", resolves: Mapping[str, Resolve] | None = None,
    by_time: Collection[str] = (),
) -> None:
    """Apply one batch to many targets by the `target` column of the log, `TOGETHER` of them at a time.

    A log that is costly to read is best stored by target.  Targets are independent: where one fails the
    others are published, and the batch that is tried again passes over them.
    """

    def one(name: str, table: BucketTable) -> None:
        fold, merge = plans[name]
        resolve = (resolves or {}).get(name)
        part = log.filter(log["target"] == name)
        apply_batch(table, part, fold, merge, batch, fence, source, resolve, name in by_time, deal=False)

    with ThreadPoolExecutor(TOGETHER) as pool:
        each = inheritable_thread_target(log.sparkSession)(one)
        jobs = [pool.submit(each, name, table) for name, table in tables.items()]
    for job in jobs:
        job.result()


def apply_stream(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Run `each_batch(records, batch id)` on every micro-batch; trigger as in writeStream.trigger."""
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_rates(
    stream: DataFrame, time: str, width: str, delay: str, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write the rate of every window of event time once it is closed, `delay` after its end.

    Closed windows leave the state, which so holds the windows of `width + delay` only.  A window stays open
    until records younger than its end and the delay arrive; a source that may end sends a heartbeat.
    """
    rates = ingest_rate(stream.withWatermark(time, delay), time, width)
    writer = rates.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def drop_repeated(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop records delivered more than once within the watermark."""
    return stream.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(
        ["topic", "partition", "offset"]
    )
