"""Write models: operations from plain records, outside change-event mode.

A write model maps the change log to the columns of its operations.  Writes and
deletes are chosen per record inside one projection, so the log is read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as attribute

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions import jsontext
from tidefold.functions.walk import as_struct
from tidefold.model import DELETE, ID, LOG_POSITION, PRESENT, REPLACE, SET, field, log_ord, struct_type
from tidefold.operators.errors import add_error, first_error

# fixed values: documented names of the stored times
MODIFIED, INSERTED = "_modifiedTS", "_insertedTS"


@dataclass(frozen=True)
class Op:
    """Columns of the operations a model makes; deletes have no document."""

    k: Column
    op: str
    upsert: bool
    doc: Column | None = None
    errors: list[tuple[Column, str]] = attribute(default_factory=list)


WriteModel = Callable[[DataFrame], Op]


def skip_empty(log: DataFrame, delete_on_null: bool = False) -> DataFrame:
    """Drop records that nothing can be made of."""
    has_value, has_key = F.col("value").isNotNull(), F.col("key").isNotNull()
    return log.filter(has_value | has_key if delete_on_null else has_value)


def write_ops(log: DataFrame, model: WriteModel, deletes: WriteModel | None = None) -> DataFrame:
    """Operations of records with a value by `model`, of records without one by `deletes`."""
    log = skip_empty(log, deletes is not None)
    write = model(log)
    if deletes is None:
        df = add_error(log, first_error(*write.errors))
        chosen = [write.k, F.lit(write.op), F.lit(write.upsert), write.doc]
    else:
        drop = deletes(log)
        has_value = F.col("value").isNotNull()
        pick = lambda w, d: F.when(has_value, w).otherwise(d)
        df = add_error(log, pick(first_error(*write.errors), first_error(*drop.errors)))
        chosen = [
            pick(write.k, drop.k),
            pick(F.lit(write.op), F.lit(drop.op)),
            pick(F.lit(write.upsert), F.lit(drop.upsert)),
            F.when(has_value, write.doc),
        ]
    names = ["k", "op", "upsert", "doc"]
    if PRESENT in log.columns:
        chosen.append(_written(log, write.doc))
        names.append(PRESENT)
    return df.select(*LOG_POSITION, *[c.alias(n) for c, n in zip(chosen, names)], log_ord(log=log).alias("ord"), "err")


def _written(log: DataFrame, doc: Column) -> Column:
    """Names the record held, and those the model adds; null (all) where that is not known."""
    have = log.schema["value"].dataType
    made = log.select(doc.alias("d")).schema["d"].dataType
    if not isinstance(made, T.StructType) or not isinstance(have, T.StructType):
        return F.lit(None).cast("array<string>")
    added = F.array(*[F.lit(n) for n in made.names if n not in have.names]).cast("array<string>")
    return F.concat(F.col(PRESENT), added)


def _id() -> Column:
    return field(F.col("value"), ID)


def replace_by_id(df: DataFrame) -> Op:
    """Replace the document with this `_id`, or insert it."""
    return Op(_id(), REPLACE, True, F.col("value"), [(F.col("value").isNull(), "value is missing")])


def replace_by_business_key(df: DataFrame) -> Op:
    """The `_id` document holds the business key: it finds the document and is not stored.

    The stored `_id` is made on the first insert and kept afterwards, see
    `operators.merge.merge_latest`.
    """
    dtype = struct_type(df, "value")
    if ID not in dtype.names or not isinstance(dtype[ID].dataType, T.StructType):
        raise ValueError("a business key needs an _id document in the value")
    value = F.col("value")
    body = as_struct(value, [field(value, n).alias(n) for n in dtype.names if n != ID])
    return Op(_id(), REPLACE, True, body, [(_id().isNull(), "value holds no _id document")])


def set_with_timestamps(now: Column) -> WriteModel:
    """Set all fields and the time of change; `now` is a parameter of the run."""

    def build(df: DataFrame) -> Op:
        value = F.col("value")
        names = [n for n in struct_type(df, "value").names if n != MODIFIED]
        doc = as_struct(value, [*[field(value, n).alias(n) for n in names], now.alias(MODIFIED)])
        return Op(_id(), SET, True, doc, [(value.isNull(), "value is missing")])

    return build


def row_upsert(keys: list[str], modified: Column | None = None, modified_column: str = "modified_ms") -> WriteModel:
    """Upsert a row: the columns of the document are written, others keep their value.

    With `modified`, the row is stamped with that time in epoch milliseconds.
    """

    def build(df: DataFrame) -> Op:
        value = F.col("value")
        names = [n for n in struct_type(df, "value").names if modified is None or n != modified_column]
        parts = [field(value, n).alias(n) for n in names]
        if modified is not None:
            parts.append(modified.cast("bigint").alias(modified_column))
        k = F.struct(*[field(value, n).alias(n) for n in keys])
        return Op(k, SET, True, as_struct(value, parts), [(value.isNull(), "value is missing")])

    return build


def _key_errors() -> list[tuple[Column, str]]:
    return [(F.col("key").isNull(), "key is missing")]


def delete_by_id(id_strategy) -> WriteModel:
    """Delete the document whose `_id` the strategy derives from the key."""

    def build(df: DataFrame) -> Op:
        k, errors = id_strategy(df)
        return Op(k, DELETE, False, None, _key_errors() + errors)

    return build


def delete_by_key(df: DataFrame) -> Op:
    """Delete by the key itself: by its `_id` where it has one, else by the whole key."""
    key, dtype = F.col("key"), struct_type(df, "key")
    whole = jsontext.struct_text(key, dtype)
    k = F.coalesce(field(key, ID).cast("string"), whole) if ID in dtype.names else whole
    return Op(k, DELETE, False, None, _key_errors())


def row_delete(keys: list[str]) -> WriteModel:
    """Delete the row with this key."""

    def build(df: DataFrame) -> Op:
        k = F.struct(*[field(F.col("key"), n).alias(n) for n in keys])
        return Op(k, DELETE, False, None, _key_errors())

    return build
