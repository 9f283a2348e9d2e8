"""Fold the operations of a key into one change.

Only aggregates with a map-side part touch the raw operations, so a key holding a
third of the log reaches the shuffle as a few rows per task.  Windows and
collected fields come after that, over at most one row per (key, field).

The folded change of a key says what to do with whatever the target holds:
`reset` is the last REPLACE or DELETE (null: none), `reset_ord` its place, and
writes before it are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidefold.model import DELETE, REPLACE, SET
from tidefold.operators.scan import BLOCK, order_block

FIELD, RESET, UPSERT = "field", "reset", "upsert"


def fold_latest(ops: DataFrame) -> DataFrame:
    """Last writer wins, for logs of whole documents and deletes only."""
    last = F.max_by(F.struct("op", "doc"), F.col("ord")).alias("w")
    return ops.groupBy("k").agg(last, F.max("ord").alias("ord")).select("k", "w.op", "w.doc", "ord")


def fold_columns(ops: DataFrame, mixed_upserts: bool = False, width: int = BLOCK) -> DataFrame:
    """Column by column: the last value written to each column.

    `present` names the columns an operation writes (null or no such column: all).
    Writes that must not create a row only matter once the row exists.  Where a log
    holds both creating and other writes (`mixed_upserts`), `first_upsert` finds the
    point from which a missing row exists.
    """
    columns = ops.schema["doc"].dataType.names
    resets = F.col("op").isin(REPLACE, DELETE)
    writes = F.col("op").isin(REPLACE, SET)
    has_present = "present" in ops.columns
    order = F.col("ord")

    def written(name: str) -> Column:
        listed = F.array_contains("present", name) | F.col("present").isNull() if has_present else F.lit(True)
        return writes & listed

    def last(name: str) -> Column:
        pair = F.struct(F.col("doc").getField(name).alias("v"), order.alias("ord"))
        return F.max_by(pair, F.when(written(name), order)).alias(name)

    # max_by ignores rows whose order is null, which is the FILTER of this aggregate
    folded = ops.groupBy("k").agg(
        F.max_by("op", F.when(resets, order)).alias("reset"),
        F.max(F.when(resets, order)).alias("reset_ord"),
        F.max(F.when(F.col("upsert") & writes, order)).alias("last_upsert"),
        F.max(order).alias("ord"),
        F.struct(*[last(c) for c in columns]).alias("cols"),
    )
    live = lambda c: F.when(
        F.col("reset_ord").isNull() | (c.getField("ord") >= F.col("reset_ord")), c
    )
    folded = folded.withColumn("cols", F.struct(*[live(F.col("cols").getField(c)).alias(c) for c in columns]))
    created = F.col("reset_ord").isNull() | (F.col("last_upsert") >= F.col("reset_ord"))
    folded = folded.withColumn("creates", F.coalesce(F.col("last_upsert").isNotNull() & created, F.lit(False)))
    if mixed_upserts:
        folded = folded.join(first_upsert(ops, width), "k", "left")
    else:
        folded = folded.withColumn("from_ord", F.lit(None).cast(ops.schema["ord"].dataType))
    return folded.drop("last_upsert")


def first_upsert(ops: DataFrame, width: int = BLOCK) -> DataFrame:
    """Per key: the first creating write after its last reset, as `from_ord`.

    Inside a block of the order, then over the blocks of a key: in blocks before the
    last reset any such write lies before it too and is passed over.
    """
    writes, resets = F.col("upsert") & (F.col("op") != DELETE), F.col("op").isin(REPLACE, DELETE)
    events = ops.filter(writes | resets).select(
        "k",
        "ord",
        order_block(F.col("ord"), ops.schema["ord"].dataType, width).alias("_block"),
        F.when(resets, F.col("ord")).alias("_reset"),
        F.when(writes, F.col("ord")).alias("_write"),
    )
    in_block = Window.partitionBy("k", "_block")
    after = F.col("_last").isNull() | (F.col("_write") >= F.col("_last"))
    blocks = (
        events.withColumn("_last", F.max("_reset").over(in_block))
        .groupBy("k", "_block")
        .agg(F.max("_last").alias("_last"), F.min(F.when(after, F.col("_write"))).alias("_first"))
    )
    of_key = Window.partitionBy("k")
    blocks = blocks.withColumn("_reset", F.max("_last").over(of_key))
    after = F.col("_reset").isNull() | (F.col("_first") >= F.col("_reset"))
    return blocks.groupBy("k").agg(F.min(F.when(after, F.col("_first"))).alias("from_ord"))


def field_rows(ops: DataFrame) -> DataFrame:
    """One row per field an operation writes or removes, and one per reset or creation."""
    mark = lambda kind, when: F.when(
        when,
        F.struct(F.lit(kind).alias("kind"), F.lit("").alias("name"), F.col("op").alias("act"),
                 F.lit(None).cast("string").alias("value")),
    )
    is_reset = F.col("op").isin(REPLACE, DELETE)
    write = lambda e: F.struct(
        F.lit(FIELD).alias("kind"), e["key"].alias("name"), F.lit("set").alias("act"), e["value"].alias("value")
    )
    remove = lambda n: F.struct(
        F.lit(FIELD).alias("kind"), n.alias("name"), F.lit("unset").alias("act"),
        F.lit(None).cast("string").alias("value"),
    )
    # a field both removed and set by one operation keeps what was set
    unsets = F.filter("unsets", lambda n: ~F.map_contains_key("sets", n))
    events = F.concat(
        F.filter(F.array(mark(RESET, is_reset), mark(UPSERT, F.col("upsert"))), lambda m: m.isNotNull()),
        F.transform(F.map_entries("sets"), write),
        F.transform(unsets, remove),
    )
    return ops.select("k", "ord", F.explode(events).alias("e")).select("k", "ord", "e.*")


def latest_fields(ops: DataFrame) -> DataFrame:
    """Last event per (key, field) with the reset of the key beside it; dead fields are gone."""
    latest = field_rows(ops).groupBy("k", "kind", "name").agg(
        F.max_by(F.struct("act", "value"), F.col("ord")).alias("e"), F.max("ord").alias("ord")
    )
    key = Window.partitionBy("k")
    of = lambda kind, col: F.max(F.when(F.col("kind") == kind, col)).over(key)
    latest = latest.select(
        "k", "kind", "name", "e.act", "e.value", "ord",
        of(RESET, F.col("e.act")).alias("reset"),
        of(RESET, F.col("ord")).alias("reset_ord"),
        of(UPSERT, F.col("ord")).alias("last_upsert"),
    )
    alive = F.col("reset_ord").isNull() | (F.col("ord") >= F.col("reset_ord"))
    return latest.filter((F.col("kind") != FIELD) | alive)


def fold_fields(ops: DataFrame) -> DataFrame:
    """Fold JSON documents field by field (top-level names).

    Gives per key: reset, whether the key is created when missing, the fields set
    and the fields removed.  All creating writes of one log must be of one kind:
    replacements beside non-creating patches, or creating sets only.
    """
    rows = latest_fields(ops)
    is_field = F.col("kind") == FIELD
    sets = F.collect_list(F.when(is_field & (F.col("act") == "set"), F.struct("name", "value")))
    unsets = F.collect_list(F.when(is_field & (F.col("act") == "unset"), F.col("name")))
    folded = rows.groupBy("k").agg(
        F.max("reset").alias("reset"),
        F.max("reset_ord").alias("reset_ord"),
        F.max("last_upsert").alias("last_upsert"),
        F.max("ord").alias("ord"),
        F.map_from_entries(sets).alias("sets"),
        unsets.alias("unsets"),
    )
    creates = F.coalesce(
        F.col("last_upsert").isNotNull()
        & (F.col("reset_ord").isNull() | (F.col("last_upsert") >= F.col("reset_ord"))),
        F.lit(False),
    )
    return folded.withColumn("creates", creates).drop("last_upsert")


def fold_images(ops: DataFrame) -> DataFrame:
    """State of each key after folding into an empty target, one row per live field."""
    rows = latest_fields(ops)
    exists = (F.col("reset") == REPLACE) | (
        F.col("last_upsert").isNotNull()
        & (F.col("reset_ord").isNull() | (F.col("last_upsert") >= F.col("reset_ord")))
    )
    return rows.filter(exists & (F.col("kind") == FIELD) & (F.col("act") == "set")).select("k", "name", "value", "ord")
