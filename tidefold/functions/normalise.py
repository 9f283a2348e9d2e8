"""Type normalisation: source types to the types stored in targets.

Logical types ride on the field metadata (`logical`), and so do the null rule
(`optional`, `default`).  One call turns a schema into casts; nothing is looked at
per row.
"""

from __future__ import annotations

import decimal
import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions.walk import as_struct
from tidefold.operators.errors import add_error, first_error

# Logical type names found in record schemas.
LOGICAL_NAMES = {
    "org.apache.kafka.connect.data.Decimal": "decimal",
    "org.apache.kafka.connect.data.Date": "date",
    "org.apache.kafka.connect.data.Time": "time",
    "org.apache.kafka.connect.data.Timestamp": "timestamp",
    "io.debezium.time.Date": "epoch_day",
    "io.debezium.time.Timestamp": "local_ms",
    "io.debezium.time.MicroTimestamp": "local_us",
    "io.debezium.time.ZonedTimestamp": "zoned",
}

# Primitive type names found in record schemas.
PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}


@dataclass(frozen=True)
class TypeOptions:
    """`source_offset_hours`: zone of wall-clock times; `legacy_decimal`: decimals as doubles."""

    source_offset_hours: int = 8
    legacy_decimal: bool = False


def logical(name: str | None = None, optional: bool = True, default: Any = None) -> dict:
    """Field metadata for a logical type and the null rule."""
    meta: dict[str, Any] = {"optional": optional}
    if name:
        meta["logical"] = name
    if default is not None:
        meta["default"] = default
    return meta


def schema_from_envelope(schema_json: str) -> T.StructType:
    """Spark schema of the `schema` part of a JSON record that carries its schema."""
    return _struct(json.loads(schema_json))


def _struct(node: dict) -> T.StructType:
    return T.StructType([_field(f["field"], f) for f in node["fields"]])


def _field(name: str, node: dict) -> T.StructField:
    meta = logical(LOGICAL_NAMES.get(node.get("name", "")), node.get("optional", False), node.get("default"))
    if meta.get("logical") == "decimal":
        meta["scale"] = int(node.get("parameters", {}).get("scale", 0))
    return T.StructField(name, _type(node), True, meta)


def _type(node: dict) -> T.DataType:
    kind = node["type"]
    if kind == "struct":
        return _struct(node)
    if kind == "array":
        return T.ArrayType(_type(node["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), _type(node["values"]))
    if kind not in PRIMITIVES:
        raise ValueError(f"unsupported type {kind!r}")
    return PRIMITIVES[kind]


def _wall_clock(millis: Column, opts: TypeOptions) -> Column:
    return F.timestamp_millis(millis - F.lit(opts.source_offset_hours * 3_600_000))


MAX_DECIMAL_BYTES = 16


def decimal_of_bytes(col: Column, scale: int) -> Column:
    """Decimal written as the big-endian bytes of its unscaled value; null beyond 38 digits."""
    text = F.hex(col)
    negative = F.substring(text, 1, 1) >= "8"
    wide = F.when(negative, F.lpad(text, 32, "F")).otherwise(F.lpad(text, 32, "0"))
    whole = lambda part, base: F.conv(part, 16, base).cast("decimal(20,0)")
    high, low = whole(F.substring(wide, 1, 16), -10), whole(F.substring(wide, 17, 16), 10)
    step = F.lit(decimal.Decimal(2**64))
    # from the nearer end to zero, so that no part is longer than the whole
    down = F.try_subtract(F.try_multiply(high + 1, step), step - low)
    up = F.try_add(F.try_multiply(high, step), low)
    unscaled = F.when(F.length(col) <= MAX_DECIMAL_BYTES, F.when(negative, down).otherwise(up)).cast("string")
    digits = F.regexp_replace(unscaled, "^-", "")
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
    point = F.length(digits) - scale
    sign = F.when(unscaled.startswith("-"), "-").otherwise("")
    parts = [sign, F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.lit(scale))]
    return F.concat(*parts).cast(T.DecimalType(38, scale))


def scalar(col: Column, dtype: T.DataType, meta: dict, opts: TypeOptions) -> Column:
    """Stored value of one scalar."""
    name = meta.get("logical")
    if isinstance(dtype, T.BinaryType) and name == "decimal":
        value = decimal_of_bytes(col, meta.get("scale", 0))
        return value.cast("double") if opts.legacy_decimal else value
    if isinstance(dtype, T.DecimalType):
        return col.cast("double") if opts.legacy_decimal else col
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return col.cast("int")
    if isinstance(dtype, T.FloatType):
        return col.cast("double")
    if name in ("time", "timestamp"):
        return F.timestamp_millis(col)
    if name == "date":
        return F.date_from_unix_date(col.cast("int"))
    if name == "epoch_day":
        return col.cast("bigint")
    if name == "local_ms":
        return _wall_clock(col, opts)
    if name == "local_us":
        return _wall_clock(F.call_function("div", col, F.lit(1000)), opts)
    if name == "zoned":
        return F.try_to_timestamp(col)
    return col


def convert(col: Column, dtype: T.DataType, meta: dict, opts: TypeOptions) -> Column:
    """Stored value of a column of any type; a null container stays null.

    Elements of arrays and maps take the logical type of their container's field.
    """
    if isinstance(dtype, T.StructType):
        if not any(changes(f.dataType, f.metadata, opts) for f in dtype.fields):
            return col
        return as_struct(col, [field_value(col, f, opts).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, (T.ArrayType, T.MapType)) and not changes(dtype, meta, opts):
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: convert(x, dtype.elementType, meta, opts))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: convert(v, dtype.valueType, meta, opts))
    return scalar(col, dtype, meta, opts)


def field_value(parent: Column, f: T.StructField, opts: TypeOptions) -> Column:
    """One field of a document, its default standing in for null."""
    col = parent.getField(f.name)
    if "default" in f.metadata:
        col = F.coalesce(col, F.lit(f.metadata["default"]).cast(f.dataType))
    return convert(col, f.dataType, f.metadata, opts)


def changes(dtype: T.DataType, meta: dict, opts: TypeOptions) -> bool:
    """Whether normalising this type is more than passing it through."""
    if "default" in meta or meta.get("logical"):
        return True
    if isinstance(dtype, T.StructType):
        return any(changes(f.dataType, f.metadata, opts) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return changes(dtype.elementType, {}, opts)
    if isinstance(dtype, T.MapType):
        return changes(dtype.valueType, {}, opts)
    return isinstance(dtype, (T.ByteType, T.ShortType, T.FloatType)) or (
        isinstance(dtype, T.DecimalType) and opts.legacy_decimal
    )


def missing_required(col: Column, dtype: T.StructType, path: str = "") -> list[tuple[Column, str]]:
    """Conditions under which a required field without default is null."""
    found = []
    for f in dtype.fields:
        name = f"{path}{f.name}"
        value = col.getField(f.name)
        if f.metadata.get("optional", True) is False and "default" not in f.metadata:
            found.append((col.isNotNull() & value.isNull(), f"required field {name} is null"))
            if isinstance(f.dataType, T.ArrayType):
                found.append((F.exists(value, lambda x: x.isNull()), f"required field {name} holds null"))
            elif isinstance(f.dataType, T.MapType):
                found.append(
                    (F.exists(F.map_values(value), lambda x: x.isNull()), f"required field {name} holds null")
                )
        found += _below(missing_required, value, f.dataType, f"{name}.")
    return found


def _below(rule, value: Column, dtype: T.DataType, path: str) -> list[tuple[Column, str]]:
    """What a rule finds in a document, or in any document of an array or map."""
    if isinstance(dtype, T.StructType):
        return rule(value, dtype, path)
    if isinstance(dtype, T.MapType):
        return _below(rule, F.map_values(value), T.ArrayType(dtype.valueType), path)
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, T.StructType):
        return []

    def any_of(nth: int) -> Column:
        return F.exists(value, lambda x: F.coalesce(rule(x, dtype.elementType, path)[nth][0], F.lit(False)))

    return [(any_of(i), reason) for i, (_, reason) in enumerate(rule(F.lit(None).cast(dtype.elementType), dtype.elementType, path))]


def unreadable(col: Column, dtype: T.StructType, path: str = "") -> list[tuple[Column, str]]:
    """Conditions under which the text of a time is none, or a decimal is too long."""
    found = []
    bad = lambda x: x.isNotNull() & F.try_to_timestamp(x).isNull()
    for f in dtype.fields:
        name, value = f"{path}{f.name}", col.getField(f.name)
        if f.metadata.get("logical") == "zoned":
            is_list = isinstance(f.dataType, T.ArrayType)
            found.append((F.exists(value, bad) if is_list else bad(value), f"field {name} is no time"))
        if isinstance(f.dataType, T.BinaryType) and f.metadata.get("logical") == "decimal":
            lost = value.isNotNull() & decimal_of_bytes(value, f.metadata.get("scale", 0)).isNull()
            found.append((lost, f"field {name} has too many digits"))
        found += _below(unreadable, value, f.dataType, f"{name}.")
    return found


def unsupported(dtype: T.DataType, path: str = "") -> list[str]:
    """Paths whose types no target takes: containers directly inside containers."""
    inner = lambda t: t.elementType if isinstance(t, T.ArrayType) else t.valueType
    if isinstance(dtype, T.StructType):
        return [p for f in dtype.fields for p in unsupported(f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        if isinstance(inner(dtype), (T.ArrayType, T.MapType)):
            return [path]
        return unsupported(inner(dtype), path)
    if isinstance(dtype, (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)):
        return [path]
    return []


def normalise(df: DataFrame, column: str = "value", opts: TypeOptions = TypeOptions()) -> DataFrame:
    """Normalise the document in `column`; rows breaking the null rule get a reason code."""
    dtype = df.schema[column].dataType
    bad = unsupported(dtype)
    if bad:
        raise ValueError(f"unsupported types at {bad}")
    col = F.col(column)
    errors = missing_required(col, dtype) + unreadable(col, dtype)
    if errors:
        df = add_error(df, first_error(*errors))
    return df.withColumn(column, convert(col, dtype, {}, opts))
