"""Change-log sources, batch and streaming, in one row shape.

Raw logs hold key and value as text or bytes; `sources.decode` gives them types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidefold.model import LOG_META

# Codes of the log's timestamp types.
TIMESTAMP_TYPES = {0: "CREATE_TIME", 1: "LOG_APPEND_TIME"}


def from_kafka(raw: DataFrame) -> DataFrame:
    """Rows of Spark's `kafka` source as a change log; key and value stay bytes, which the decoders read."""
    names = F.create_map(*[F.lit(x) for pair in TIMESTAMP_TYPES.items() for x in pair])
    return raw.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.coalesce(names[F.col("timestampType")], F.lit("NO_TIMESTAMP_TYPE")).alias("timestamp_type"),
        "key",
        "value",
    )


def read_log(spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """A bounded replay of a log: everything there is now."""
    reader = spark.read.format(fmt).options(**options)
    raw = _load(reader, path, schema)
    return from_kafka(raw) if fmt == "kafka" else raw


def stream_log(spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """The same log as a stream."""
    reader = spark.readStream.format(fmt).options(**options)
    raw = _load(reader, path, schema)
    return from_kafka(raw) if fmt == "kafka" else raw


def _load(reader, path, schema) -> DataFrame:
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def log_columns(df: DataFrame) -> DataFrame:
    """The change-log columns in their usual order; missing metadata becomes null."""
    types = {"partition": "int", "offset": "bigint", "timestamp": "timestamp"}
    meta = [
        F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in LOG_META
    ]
    return df.select(*meta, "key", "value")


def with_nulls(log: DataFrame) -> DataFrame:
    """Empty payloads as absent: sources without null payloads send empty ones."""
    empty = lambda c: F.when(F.length(c) > 0, F.col(c)).alias(c)
    text = [c for c in ("key", "value") if isinstance(log.schema[c].dataType, (T.StringType, T.BinaryType))]
    return log.select(*[empty(c) if c in text else F.col(c) for c in log.columns])
