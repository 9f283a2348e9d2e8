"""Checks on targets: counts, samples, missing keys, duplicate keys, ingest rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def target_counts(targets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per target."""
    counts = [
        df.groupBy(F.lit(name).alias("target")).agg(F.count(F.lit(1)).alias("n")) for name, df in targets.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def sample(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by key: the same rows on every run."""
    return df.orderBy(*keys).limit(n)


def missing_keys(produced: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were produced but are not in the target."""
    return produced.select(*keys).distinct().join(target.select(*keys), list(keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row of a target holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def split_keys(ops: DataFrame) -> DataFrame:
    """Keys whose records come from several topic partitions, which offsets alone cannot order."""
    place = F.struct("topic", "partition")
    ends = ops.groupBy("k").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    return ends.filter("first <> last").select("k")


def ingest_rate(df: DataFrame, ts: str, every: str) -> DataFrame:
    """Rows and rows per second in windows of event time; streams need a watermark on `ts`."""
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return (
        df.groupBy(F.window(ts, every).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", (F.col("n") / seconds).alias("per_sec"))
    )
