"""Change events of relational sources: op, before image, after image.

One set of builders serves every SQL dialect.  `operations` maps the op code of an
event to its builder; a partial map makes the other codes bad records.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions.walk import as_struct
from tidefold.model import DELETE, ID, LOG_POSITION, REPLACE, SET, field, log_ord, struct_type
from tidefold.operators.errors import add_error

# Op codes of change events.
CREATE, READ, UPDATE, REMOVE = "c", "r", "u", "d"


@dataclass(frozen=True)
class Built:
    """What one kind of event turns into."""

    op: str
    upsert: bool = True
    has_doc: bool = True


DOCUMENT_TARGET: Mapping[str, Built] = {
    CREATE: Built(REPLACE),
    READ: Built(REPLACE),
    UPDATE: Built(REPLACE),
    REMOVE: Built(DELETE, upsert=False, has_doc=False),
}
ROW_TARGET: Mapping[str, Built] = {
    CREATE: Built(SET),
    READ: Built(SET),
    UPDATE: Built(SET, upsert=False),
    REMOVE: Built(DELETE, upsert=False, has_doc=False),
}


def check_op(df: DataFrame, op: Column, known) -> DataFrame:
    """Reason codes for op codes that are missing or have no builder."""
    return add_error(
        df,
        F.when(op.isNull(), F.lit("op is missing")).when(
            ~op.isin(*known), F.concat(F.lit("op is not handled: "), op)
        ),
    )


def op_code(df: DataFrame) -> Column:
    """The op code; a code of another type than string counts as missing."""
    env = struct_type(df, "value")
    if env is None or "op" not in env.names or not isinstance(env["op"].dataType, T.StringType):
        return F.lit(None).cast("string")
    return field(F.col("value"), "op")


def skip_tombstones(df: DataFrame) -> DataFrame:
    """Null values only mark keys for log compaction."""
    return df.filter(F.col("value").isNotNull())


def case_of(op: Column, built: Mapping[str, Built], pick) -> Column:
    """CASE over the op codes."""
    out = None
    for code, b in built.items():
        v = pick(b)
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(op == code, v) if out is None else out.when(op == code, v)
    return out


def relational_ops(
    log: DataFrame,
    target: str = "document",
    operations: Mapping[str, Built] | None = None,
    pk_in_id: bool = True,
) -> DataFrame:
    """Operations of a keyed relational log.

    `document` targets hold the primary key in `_id` and the other columns beside it,
    `row` targets keep the row as it is.  `k` is the primary key struct.  Records
    without a key are bad here: inserts of tables without any key go through
    `keyless_insert_id`, their other changes through `operators.keyless`.
    """
    built = operations or (DOCUMENT_TARGET if target == "document" else ROW_TARGET)
    df = skip_tombstones(log)
    op = op_code(df)
    df = check_op(df, op, built.keys())

    key, after = F.col("key"), field(F.col("value"), "after")
    after_type = struct_type(df, "value")["after"].dataType
    keys = [f.name for f in struct_type(df, "key").fields]
    has_doc = op.isin(*[c for c, b in built.items() if b.has_doc])
    empty = ~F.greatest(*[F.lit(False), *[field(after, f.name).isNotNull() for f in after_type.fields]])
    df = add_error(df, F.when(has_doc & (after.isNull() | empty), F.lit("after is missing or empty")))
    df = add_error(df, F.when(key.isNull(), F.lit("key is missing")))

    if target == "document":
        body = [field(after, f.name).alias(f.name) for f in after_type.fields if not (pk_in_id and f.name in keys)]
        doc = F.struct(key.alias(ID), *body) if pk_in_id else F.struct(*body)
    else:
        doc = after
    return df.select(
        *LOG_POSITION,
        key.alias("k"),
        case_of(op, built, lambda b: b.op).alias("op"),
        case_of(op, built, lambda b: b.upsert).alias("upsert"),
        F.when(has_doc, doc).alias("doc"),
        log_ord(log=df).alias("ord"),
        "err",
    )


def keyless_insert_id(log: DataFrame, id_column: Column | None = None) -> DataFrame:
    """Inserts of a table without key as documents with a generated `_id`."""
    df = skip_tombstones(log)
    op = op_code(df)
    after = field(F.col("value"), "after")
    new_id = id_column if id_column is not None else F.substring(
        F.sha2(F.concat_ws("#", "topic", "partition", "offset"), 256), 1, 24
    )
    names = struct_type(df, "value")["after"].dataType.names
    return df.filter(op.isin(CREATE, READ)).select(
        new_id.alias("k"),
        F.lit(REPLACE).alias("op"),
        as_struct(after, [new_id.alias(ID), *[field(after, n).alias(n) for n in names]]).alias("doc"),
        log_ord().alias("ord"),
    )
