"""JSON text held in record fields, read as VARIANT inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Change events of document stores write keys without quotes now and then.
RELAXED = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def parse(text: Column) -> Column:
    """VARIANT of a JSON text, null when the text is no JSON."""
    return F.from_json(text, "variant", RELAXED)


def canonical(text: Column) -> Column:
    """One spelling per JSON value (object keys sorted, numbers normalised)."""
    return F.to_json(parse(text))


def fields(text: Column) -> Column:
    """Top-level fields of a JSON object as MAP<name, JSON text>; null for anything else."""
    return texts(members(parse(text)))


def members(value: Column) -> Column:
    """Top-level fields of a VARIANT object as MAP<name, VARIANT>; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def texts(variants: Column) -> Column:
    return F.transform_values(variants, lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def document(field_texts: Column) -> Column:
    """JSON object text of MAP<name, JSON text>, in canonical spelling."""
    return F.to_json(F.to_variant_object(F.transform_values(field_texts, lambda _, v: F.parse_json(v))))


def struct_text(col: Column, dtype: T.StructType, nulls: bool = True) -> Column:
    """JSON text of a struct with keys in sorted order at every level, nulls kept or left out."""
    return F.to_json(_sorted(col, dtype), {"ignoreNullFields": "false" if nulls else "true"})


def _sorted(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        parts = [
            _sorted(col.getField(f.name), f.dataType).alias(f.name)
            for f in sorted(dtype.fields, key=lambda f: f.name)
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType) and _has_struct(dtype.elementType):
        return F.transform(col, lambda x: _sorted(x, dtype.elementType))
    return col


def _has_struct(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_struct(dtype.elementType)
    return isinstance(dtype, T.StructType)


def unwrap_extended_id(text: Column) -> Column:
    """Plain text of an id written as `{"$oid": ...}`, a quoted string or a number."""
    value = parse(text)
    return F.coalesce(
        F.try_variant_get(value, '$["$oid"]', "string"),
        F.try_variant_get(value, '$["$numberLong"]', "string"),
        F.try_variant_get(value, "$", "string"),
    )
