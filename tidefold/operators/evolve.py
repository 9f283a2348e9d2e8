"""Schema growth: new fields of a batch become columns of the target.

Types only widen, and keep every digit: int to bigint to decimal to string, or to double
where the value was one; what no such type holds exactly becomes text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions.once import compute_once
from tidefold.functions.walk import as_struct

WIDENING = ["tinyint", "smallint", "int", "bigint", "double", "string"]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that takes both."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType) or {a, b} == {T.LongType(), T.DoubleType()}:
        return _wider_number(a, b)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return grown(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    rank = {n: i for i, n in enumerate(WIDENING)}
    ra, rb = rank.get(a.simpleString()), rank.get(b.simpleString())
    if ra is None or rb is None:
        return T.StringType()
    return a if ra > rb else b


_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    """A decimal that holds both without rounding, text where none does."""
    sizes = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            sizes.append((t.precision - t.scale, t.scale))
        elif t.simpleString() in _DIGITS:
            sizes.append((_DIGITS[t.simpleString()], 0))
        else:
            return T.StringType()
    whole, scale = (max(s) for s in zip(*sizes))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()


def grown(have: T.StructType, incoming: T.StructType) -> T.StructType:
    """The target schema with the incoming fields added or widened; nothing is dropped."""
    fields = {f.name: f.dataType for f in have.fields}
    for f in incoming.fields:
        fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def new_fields(have: T.StructType, incoming: T.StructType) -> list[T.StructField]:
    return [f for f in incoming.fields if f.name not in have.names]


def fit(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type in a wider one; JSON text where only text takes it."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        parts = [
            (fit(col.getField(f.name), have[f.name].dataType, f.dataType) if f.name in have.names
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return as_struct(col, parts)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: fit(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast(want)


def grow(df: DataFrame, want: T.StructType) -> DataFrame:
    """Rows under a grown schema."""
    return df.select(
        *[
            (fit(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
    )


def union_grown(*frames: DataFrame) -> DataFrame:
    """Rows of all frames under the schema that takes all of them."""
    want = reduce(grown, (df.schema for df in frames))
    return reduce(DataFrame.unionByName, (grow(df, want) for df in frames))


def _plain(dtype: T.DataType) -> T.DataType:
    """Types inferred from JSON values as column types."""
    if isinstance(dtype, T.NullType):
        return T.StringType()
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType))
    return T.StringType() if isinstance(dtype, T.VariantType) else dtype


def infer(docs: DataFrame, column: str = "doc", nulls: bool = True) -> T.StructType:
    """Schema of a column of JSON object texts; without `nulls` fields that hold nothing else are left out.

    One aggregate over all rows; what reaches the driver is the schema text.
    """
    text = docs.select(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("s")).first()["s"]
    text = text.replace("OBJECT<", "STRUCT<")
    dtype = T.StructType.fromDDL(text) if text and text not in ("VOID", "VARIANT") else T.StructType()
    if not nulls and isinstance(dtype, T.StructType):
        dtype = T.StructType([f for f in dtype.fields if not isinstance(f.dataType, T.NullType)])
    return _plain(dtype) if isinstance(dtype, T.StructType) else T.StructType()


def written_columns(delta: DataFrame, stored: T.StructType | None) -> DataFrame:
    """`fold_fields` changes (`sets`: JSON texts) as `fold_columns` changes, typed as the batch needs and the target has them."""
    text = F.to_json(F.to_variant_object(F.transform_values("sets", lambda _, v: F.parse_json(v))))
    delta = delta.withColumn("_text", text)
    found = infer(delta.select("_text"), "_text", nulls=False)
    have = stored or T.StructType()
    want = T.StructType([f for f in grown(have, found).fields if f.name in found.names or f.name in have.names])
    parsed = F.from_json("_text", want) if want.fields else F.lit(None)
    delta = compute_once(delta, _row=parsed)
    cols = [F.when(F.map_contains_key("sets", f.name), F.struct(F.col("_row").getField(f.name).alias("v"), F.col("ord"))).alias(f.name)
            for f in want.fields]
    if not cols:  # deletes alone
        cols = [F.when(F.lit(False), F.struct(F.lit("").alias("v"), F.col("ord"))).alias("_id")]
    none = F.lit(None).cast(delta.schema["ord"].dataType)
    return delta.select("k", "reset", "reset_ord", "creates", none.alias("from_ord"), F.struct(*cols).alias("cols"))


def typed(docs: DataFrame, schema: T.StructType, column: str = "doc") -> DataFrame:
    """JSON object texts read with a schema; text columns take any JSON value."""
    return docs.withColumn(column, F.from_json(column, schema))
