"""Headline queries, timed: prints one JSON line.

The headline value is the time to apply the change log of orders: JSON text decoded,
folded and merged into an empty table, then the later half into the table it made.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F, types as T

from checks import applying, changes, documents, logs, records  # noqa: F401
from checks.support import QUERIES
from tidefold.operators import errors
from tidefold.plans.settings import Settings
from tidefold.sinks.folders import shared_folder
from tidefold.sources import decode as dec
from tidefold.streaming import apply as st
from tidefold.streaming.sink import ConfiguredSink

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# rows per second the reference notes for its relational change log, on hardware it does not state
NOTED_ROWS_PER_SEC = 9797

NAMES = [
    "fold_lww", "fold_patches", "fold_partial_rows", "fold_nested_patches", "merge_snapshot", "merge_patches",
    "merge_idempotent", "cdc_nopk_before_match", "cdc_row_delete", "prj_white_nested_array", "ren_regexp",
    "chain_composed", "typ_struct", "batch_numbering", "wm_delete_on_null", "str_apply_available_now",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def apply_text_log(spark: SparkSession, path: str, batches: int) -> None:
    envelope = T.StructType.fromDDL(f"op string, before {logs.ORDER_IMAGE}, after {logs.ORDER_IMAGE}")
    log = dec.decode(spark.read.parquet(path), dec.JsonPlain(records.KEY_TYPE), dec.JsonPlain(envelope))
    log = errors.good(log)
    table = applying.new_table(spark, "bench")
    parts = [log] if batches == 1 else applying.first_half(log)
    for i, part in enumerate(parts):
        st.apply_batch(table, part, applying.fold_orders, applying.latest_into, i, fence=False)


def timed_sink(spark: SparkSession, path: str) -> dict[str, float]:
    """The configured sink with its fence: the whole log into an empty table, then a thousandth of the keys again."""
    envelope = T.StructType.fromDDL(f"op string, before {logs.ORDER_IMAGE}, after {logs.ORDER_IMAGE}")
    sink = ConfiguredSink(
        spark, Settings({"cdc.handler": "mysql", "route": "orders"}), shared_folder(spark, "bench-sink"),
        key_decoder=dec.JsonPlain(records.KEY_TYPE), value_decoder=dec.JsonPlain(envelope))
    log = spark.read.parquet(path)
    later = (F.col("offset") + 1_000_000_000_000).alias("offset")
    few = log.filter(F.get_json_object(F.col("key"), "$.id").cast("bigint") % 1000 == 0)
    few = few.select(*[later if c == "offset" else F.col(c) for c in log.columns])
    return {"sink_empty_target": timed(lambda: sink.apply(log, 0)), "sink_small_delta": timed(lambda: sink.apply(few, 1))}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        # no Python call sites kept for every column: plans build faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = shared_folder(spark, "bench-log")
    # a log lies in more than one file
    logs.as_text(logs.orders_log(spark, SF_DIR)).repartition(int(CPUS)).write.parquet(path)
    rows = spark.read.parquet(path).count()
    for _ in range(2):
        apply_text_log(spark, path, 2)

    seconds = {
        "apply_empty_target": timed(lambda: apply_text_log(spark, path, 1)),
        "apply_two_halves": timed(lambda: apply_text_log(spark, path, 2)),
    }
    for name in NAMES:
        drain(QUERIES[name](spark, SF_DIR))
        seconds[name] = timed(lambda: drain(QUERIES[name](spark, SF_DIR)))
    rate = lambda n: round(rows / seconds[n])
    print(json.dumps({
        "metric": "change log applied and queries run",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "log_rows": rows,
        "rows_per_sec": {n: rate(n) for n in ("apply_empty_target", "apply_two_halves")},
        "noted_rows_per_sec": NOTED_ROWS_PER_SEC,
        "cores": int(CPUS),
        "sink_seconds": timed_sink(spark, path),
    }))


if __name__ == "__main__":
    main()
