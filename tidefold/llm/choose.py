"""Documents without some of them, or those only, chosen by id and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidefold.sinks.folders import shared_folder

# a table of at most so many rows of ids and hashes is broadcast (some 50 MB); a larger one is shuffled
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """The rows, stored, and marked for broadcast if they are few enough by count."""
    folder = shared_folder(df.sparkSession, "chosen")
    df.write.parquet(folder)
    df = df.sparkSession.read.schema(df.schema).parquet(folder)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _chosen(docs: DataFrame, some: DataFrame, how: str) -> DataFrame:
    key = lambda h: F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), h)
    some = small(some.select(key(F.col("text_hash")).alias("__some")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       key(F.xxhash64(F.col("text").cast("string"))).alias("__key"))
    kept = rows.join(some, F.col("__key") == F.col("__some"), how)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id and xxhash64 of text are not among `bad` (doc_id, text_hash)."""
    return _chosen(docs, bad, "left_anti")


def within(docs: DataFrame, some: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id and xxhash64 of text are among `some` (doc_id, text_hash)."""
    return _chosen(docs, some, "left_semi")
