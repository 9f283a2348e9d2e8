"""Connected components of links between ids, on Spark, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidefold.sinks.folders import remove, shared_folder

ROUNDS = 100


def _stored(df: DataFrame, name: str, folders: list[str] | None = None) -> DataFrame:
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    if folders is not None:
        folders.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b); a component is named by its smallest id.

    Each round hangs every id's larger neighbours, then its smaller ones, below the smallest
    neighbour, until all links are stars.  The least neighbour is found with map-side
    aggregation, so that a hub costs one row per task; its links are joined, not collected.
    """
    edge = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ids = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    ids = _stored(ids, "component-ids")
    used: list[str] = []
    now = _stored(links.filter("a <> b").select(*edge(F.col("a"), F.col("b"))).distinct(), "component-links", used)
    seen = None
    for _ in range(ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _stored(large.filter("u <> v").distinct(), "component-links", used)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(*edge(F.col("v"), F.col("m"))).union(least.select("u", F.col("m").alias("v")))
        now = _stored(small.filter("u <> v").distinct(), "component-links", used)
        while len(used) > 1:  # the links of earlier rounds
            remove(now.sparkSession, used.pop(0))
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    root = now.groupBy("u").agg(F.min("v").alias("m"))
    return ids.join(root, ids["id"] == root["u"], "left").select("id", F.coalesce("m", "id").alias("component"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of the ids 0..n-1 that each can reach by links (a, b), within one task."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(label, before):
            return label
