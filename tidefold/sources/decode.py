"""Decoders of record keys and values, chosen per column.

A decoder takes the DataFrame and a column name and returns the DataFrame with that
column decoded; payloads it cannot read get a reason code.  Null stays null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions import jsontext
from tidefold.functions.normalise import TypeOptions, normalise
from tidefold.functions.once import compute_once
from tidefold.functions.walk import as_struct
from tidefold.model import ID, PRESENT
from tidefold.operators import evolve
from tidefold.operators.errors import add_error

Decoder = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Struct:
    """Typed payloads: only the types are normalised."""

    options: TypeOptions = TypeOptions()

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        return normalise(df, column, self.options)


@dataclass(frozen=True)
class JsonWithSchema:
    """`{"schema": ..., "payload": ...}` text with the payload's schema known beforehand."""

    payload: T.StructType
    options: TypeOptions = TypeOptions()

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        envelope = T.StructType([T.StructField("payload", self.payload)])
        df = _parse(df, column, envelope)
        df = df.withColumn(column, F.col(column).getField("payload"))
        return normalise(_with_metadata(df, column, self.payload), column, self.options)


@dataclass(frozen=True)
class JsonPlain:
    """Plain JSON objects read with a given schema."""

    schema: T.StructType
    options: TypeOptions = TypeOptions()

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        if column == "value":
            # what the record holds, told from what it leaves out
            df = df.withColumn(PRESENT, F.json_object_keys(F.col(column).cast("string")))
        df = _parse(df, column, self.schema)
        return normalise(_with_metadata(df, column, self.schema), column, self.options)


@dataclass(frozen=True)
class JsonRaw:
    """Raw JSON text without a schema: canonical text, checked to be an object."""

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        df = compute_once(df, _text=jsontext.canonical(F.col(column).cast("string")))
        bad = F.col(column).isNotNull() & ~F.coalesce(F.col("_text").startswith("{"), F.lit(False))
        df = add_error(df, F.when(bad, F.lit(f"{column} is no JSON object")))
        return df.withColumn(column, F.col("_text")).drop("_text")


@dataclass(frozen=True)
class JsonInferred:
    """JSON objects without a schema: the one that takes all of the batch is inferred.

    Fields of several types become the wider one, or JSON text.  Targets grow with the batches.
    """

    options: TypeOptions = TypeOptions()

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        text = jsontext.canonical(F.col(column).cast("string"))
        known = df.select(text.alias("doc")).filter(F.col("doc").startswith("{"))
        schema = evolve.infer(known)
        if not schema.fields:
            schema = T.StructType([T.StructField(ID, T.StringType())])
        return JsonPlain(schema, self.options)(df, column)


@dataclass(frozen=True)
class Avro:
    """Avro payloads, where Spark's avro module is deployed; `header` bytes before them are left out.

    Payloads written through a schema registry begin with a header of five bytes.
    """

    schema_json: str
    options: TypeOptions = TypeOptions()
    header: int = 0

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        from pyspark.sql.avro.functions import from_avro

        return normalise(df.withColumn(column, from_avro(self.body(column), self.schema_json)), column, self.options)

    def body(self, column: str) -> Column:
        raw = F.col(column).cast("binary")
        return F.substring(raw, self.header + 1, 2**31 - 1) if self.header else raw


@dataclass(frozen=True)
class AvroRegistry:
    """Avro payloads of several writer schemas, by the schema id in the registry's header of five bytes.

    Every record is decoded by its own writer's schema; all come out under the one that takes them all.
    A record of an unknown schema is bad.  `schemas` maps ids to schemas, as the registry gives them.
    """

    schemas: Mapping[int, str]
    options: TypeOptions = TypeOptions()

    def schema_id(self, column: str) -> Column:
        """The id in the header; null for payloads without one."""
        raw = F.col(column).cast("binary")
        told = (F.octet_length(raw) >= 5) & (F.hex(F.substring(raw, 1, 1)) == "00")
        return F.when(told, F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).cast("bigint"))

    def __call__(self, df: DataFrame, column: str) -> DataFrame:
        from pyspark.sql.avro.functions import from_avro

        body = F.substring(F.col(column).cast("binary"), 6, 2**31 - 1)
        df = df.withColumn("_schema", self.schema_id(column))
        names = {i: f"_avro_{i}" for i in sorted(self.schemas)}
        # a branch is evaluated for the records of its schema only
        df = compute_once(df, **{n: F.when(F.col("_schema") == i, from_avro(body, self.schemas[i])) for i, n in names.items()})
        types = {n: df.schema[n].dataType for n in names.values()}
        want = reduce(evolve.grown, types.values())
        known = F.col("_schema").isin(*names)
        df = add_error(df, F.when(F.col(column).isNotNull() & ~F.coalesce(known, F.lit(False)), F.lit(f"{column} is of an unknown schema")))
        df = df.withColumn(column, F.coalesce(*[evolve.fit(F.col(n), t, want) for n, t in types.items()]))
        return normalise(df.drop("_schema", *names.values()), column, self.options)


CORRUPT = "_corrupt"


def _parse(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parse JSON text once; text that is no JSON of this schema gets a reason code."""
    with_mark = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(column).cast("string"), with_mark, {"columnNameOfCorruptRecord": CORRUPT})
    df = compute_once(df, **{column: parsed})
    doc = F.col(column)
    df = add_error(df, F.when(doc.getField(CORRUPT).isNotNull(), F.lit(f"{column} is no JSON of its schema")))
    return df.withColumn(column, as_struct(doc, [doc.getField(f.name).alias(f.name) for f in schema.fields]))


def _with_metadata(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Nested field metadata is lost by from_json; a cast to the same type restores it."""
    return df.withColumn(column, F.col(column).cast(schema))


def decode(df: DataFrame, key: Decoder | None = None, value: Decoder | None = None) -> DataFrame:
    """Decode key and value, each by its own decoder (None: taken as they are)."""
    if key is not None:
        df = key(df, "key")
    return value(df, "value") if value is not None else df


def require_payload(df: DataFrame, column: str = "value") -> DataFrame:
    """Reject records whose payload is missing."""
    return add_error(df, F.when(F.col(column).isNull(), F.lit(f"{column} is null")))
