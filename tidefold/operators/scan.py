"""Running values along the offsets of a group, in two levels.

One group (a topic partition, a key, a target) may hold most of the log, so no
window spans a whole group.  Offsets are cut into blocks of fixed width: a window
works inside a block, and a second one over the much smaller block summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidefold.model import ORDER_TIME

BLOCK = 1_000_000


def block_of(offset: Column, width: int = BLOCK) -> Column:
    return F.call_function("div", offset, F.lit(width).cast("bigint"))


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], width: int = BLOCK) -> DataFrame:
    """Add `rn`, the place (from 0) of a row in its group; order[0] is the offset."""
    df = df.withColumn("_block", block_of(F.col(order[0]), width))
    inside = Window.partitionBy(*group, "_block").orderBy(*order)
    along = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*group, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, "_block", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    )
    numbered = df.withColumn("_in", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [*group, "_block"])
        .withColumn("rn", F.col("_start") + F.col("_in"))
        .drop("_block", "_start", "_in")
    )


def running_max(
    df: DataFrame, group: Sequence[str], order: str, value: str, out: str, width: int = BLOCK
) -> DataFrame:
    """Add `out`, the greatest `value` up to and including the row."""
    df = df.withColumn("_block", block_of(F.col(order), width))
    inside = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        df.groupBy(*group, "_block")
        .agg(F.max(value).alias("_top"))
        .select(*group, "_block", F.max("_top").over(along).alias("_before"))
    )
    return (
        df.withColumn("_in", F.max(value).over(inside))
        .join(before, [*group, "_block"])
        .withColumn(out, F.greatest("_in", "_before"))
        .drop("_block", "_in", "_before")
    )


def order_times(log: DataFrame, before: DataFrame | None = None, width: int = BLOCK) -> DataFrame:
    """Add the running maximum of the record time along each topic partition.

    `before` (topic, partition, time) is what earlier batches reached, one row per topic partition.
    """
    timed = running_max(log, ["topic", "partition"], "offset", "timestamp", ORDER_TIME, width)
    if before is None:
        return timed
    reached = before.select("topic", "partition", F.col("time").alias("_reached"))
    met = timed.join(reached, ["topic", "partition"], "left")
    return met.withColumn(ORDER_TIME, F.greatest(ORDER_TIME, "_reached")).select(*timed.columns)


def order_block(ord_: Column, dtype: T.StructType, width: int = BLOCK) -> Column:
    """A number that grows with the order: blocks of offsets, or of hours where records are ordered by time."""
    if "time" in dtype.names:
        return block_of(F.unix_seconds(ord_["time"]), 3600)
    return block_of(ord_["offset"], width)


def order_across_topics(log: DataFrame, width: int = BLOCK) -> DataFrame:
    """Add `ord` for targets fed by several topics.

    Record times may run backwards inside a partition; their running maximum does
    not, so it orders records of different partitions without breaking the order
    inside one.
    """
    timed = running_max(log, ["topic", "partition"], "offset", "timestamp", "_time", width)
    place = F.struct(
        F.col("_time").alias("time"), "topic", "partition", "offset", F.lit(0).alias("sub")
    )
    return timed.withColumn("ord", place).drop("_time")
