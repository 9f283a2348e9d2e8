"""Registry of checks, table loading, and flat rendering of nested results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that gives the same rows (None: rows only)."""

    def add(query: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql.strip()
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the tables hold times without zone; the SQL reads them as UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def text_of(col: Column, dtype: T.DataType) -> Column:
    """One text per value: containers are joined, maps in key order."""
    if isinstance(dtype, T.StructType):
        return F.concat_ws(":", *[text_of(col.getField(f.name), f.dataType) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: text_of(x, dtype.elementType)), ",")
    if isinstance(dtype, T.MapType):
        entry = lambda e: F.concat_ws("=", e["key"], text_of(e["value"], dtype.valueType))
        return F.array_join(F.array_sort(F.transform(F.map_entries(col), entry)), ",")
    return plain(col, dtype).cast("string")


def plain(col: Column, dtype: T.DataType) -> Column:
    """Scalars that both engines spell alike."""
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(col)
    if isinstance(dtype, T.BooleanType):
        return col.cast("int")
    return col


def leaves(col: Column, dtype: T.DataType, name: str) -> list[Column]:
    """Columns of all leaves of a document, named by their path."""
    if isinstance(dtype, T.StructType):
        return [
            leaf
            for f in dtype.fields
            for leaf in leaves(col.getField(f.name), f.dataType, f"{name}_{f.name}" if name else f.name)
        ]
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return [text_of(col, dtype).alias(name)]
    return [plain(col, dtype).alias(name)]


def flat(df: DataFrame, *columns: str, prefix: bool = False) -> DataFrame:
    """All leaves of the given documents, and the other given columns as they are."""
    out = []
    for c in columns:
        dtype = df.schema[c].dataType
        out += leaves(F.col(c), dtype, c if prefix or not isinstance(dtype, T.StructType) else "")
    return df.select(*out)
