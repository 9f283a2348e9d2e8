"""Record identity.

A strategy is a function of the change-log DataFrame that returns the id column
and the conditions under which a record has none.  Own strategies are plain
functions of the same shape.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions import jsontext
from tidefold.functions.walk import as_struct
from tidefold.model import ID, struct_type
from tidefold.operators.errors import add_error, first_error
from tidefold.operators.project import Matcher, project_column

Errors = list[tuple[Column, str]]
IdStrategy = Callable[[DataFrame], tuple[Column, Errors]]


def _position(sep: str) -> Column:
    return F.concat_ws(sep, "topic", "partition", "offset")


def object_id(df: DataFrame) -> tuple[Column, Errors]:
    """24 hex digits derived from the log position: the same on every replay."""
    return F.substring(F.sha2(_position("#"), 256), 1, 24), []


def random_object_id(df: DataFrame) -> tuple[Column, Errors]:
    """24 random hex digits: a new id on every replay."""
    return F.substring(F.sha2(F.uuid(), 256), 1, 24), []


def uuid(df: DataFrame) -> tuple[Column, Errors]:
    return F.uuid(), []


def log_position(df: DataFrame) -> tuple[Column, Errors]:
    return _position("#"), []


def _document(df: DataFrame, column: str, matcher: Matcher | None = None) -> Column:
    """Canonical JSON of a document, `{}` where there is none."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        text = F.to_json(F.col(column)) if not isinstance(dtype, T.StringType) else F.col(column)
        return F.coalesce(jsontext.canonical(text), F.lit("{}"))
    top = matcher.root() if matcher else None
    kept = F.col(column) if top is None else project_column(F.col(column), dtype, top)
    if kept is None:
        return F.lit("{}")
    kept_type = df.select(kept.alias("d")).schema["d"].dataType
    return F.coalesce(jsontext.struct_text(kept, kept_type), F.lit("{}"))


def full_key(df: DataFrame) -> tuple[Column, Errors]:
    return _document(df, "key"), []


def partial_key(df: DataFrame, matcher: Matcher) -> tuple[Column, Errors]:
    return _document(df, "key", matcher), []


def partial_value(df: DataFrame, matcher: Matcher) -> tuple[Column, Errors]:
    return _document(df, "value", matcher), []


def _provided(df: DataFrame, column: str) -> tuple[Column, Errors]:
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StructType):
        has = any(f.name == ID for f in dtype.fields)
        value = F.col(column).getField(ID) if has else F.lit(None).cast("string")
    else:
        text = F.col(column) if isinstance(dtype, T.StringType) else F.to_json(F.col(column))
        value = F.to_json(F.try_variant_get(jsontext.parse(text), f"$.{ID}", "variant"))
        value = F.when(value != "null", value)
    return value, [(value.isNull(), f"{column} holds no {ID}")]


def provided_in_key(df: DataFrame) -> tuple[Column, Errors]:
    return _provided(df, "key")


def provided_in_value(df: DataFrame) -> tuple[Column, Errors]:
    return _provided(df, "value")


STRATEGIES: dict[str, IdStrategy] = {
    "object_id": object_id,
    "random_object_id": random_object_id,
    "uuid": uuid,
    "log_position": log_position,
    "full_key": full_key,
    "provided_in_key": provided_in_key,
    "provided_in_value": provided_in_value,
}
PARTIAL = {"partial_key": partial_key, "partial_value": partial_value}

# Only these give a deleted record the id its insert had.
KEY_BASED = {"full_key", "partial_key", "provided_in_key"}


def strategy(name: str, matcher: Matcher | None = None) -> IdStrategy:
    if name in PARTIAL:
        if matcher is None:
            raise ValueError(f"id strategy {name} needs a key projection of type blacklist or whitelist")
        return partial(PARTIAL[name], matcher=matcher)
    if name not in STRATEGIES:
        raise ValueError(f"unknown id strategy {name!r}")
    return STRATEGIES[name]


def add_id(df: DataFrame, id_strategy: IdStrategy) -> DataFrame:
    """Put the id into the value document as `_id`, where there is a value."""
    if struct_type(df, "value") is None:
        raise ValueError("value holds no fields to put an id among: decode it with a schema first")
    id_col, errors = id_strategy(df)
    value = F.col("value")
    if errors:
        df = add_error(df, F.when(value.isNotNull(), first_error(*errors)))
    own = [value.getField(f.name).alias(f.name) for f in df.schema["value"].dataType.fields if f.name != ID]
    return df.withColumn("value", as_struct(value, [id_col.alias(ID)] + own))
