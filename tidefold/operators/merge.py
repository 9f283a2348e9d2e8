"""Merge folded changes into the rows of a target.

Both sides hold one row per key, so the full outer join cannot be skewed by a hot
key.  Rows whose key has no change pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions import jsontext
from tidefold.model import DELETE, ID, LOG_POSITION, REPLACE
from tidefold.operators import evolve


def _join(target: DataFrame, delta: DataFrame, on: Sequence[str]) -> DataFrame:
    """t.* and d.* of the keys of either side, with flags for which side has the key."""
    t = target.withColumn("_t", F.lit(True)).alias("t")
    d = delta.withColumn("_d", F.lit(True)).alias("d")
    same = [F.col(f"t.{c}") == F.col(f"d.{c}") for c in on]
    return t.join(d, same, "full_outer")


def _fitted(df: DataFrame, want: T.DataType) -> DataFrame:
    """Documents under the schema that takes those of both sides."""
    return df.withColumn("doc", evolve.fit(F.col("doc"), df.schema["doc"].dataType, want))


def _keys(on: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f"d.{c}"), F.col(f"t.{c}")).alias(c) for c in on]


def merge_latest(
    target: DataFrame, delta: DataFrame, on: Sequence[str] = ("k",), generated_id: Column | None = None
) -> DataFrame:
    """Apply `fold_latest` changes: replace, insert or delete whole documents.

    With `generated_id` (business keys) a document keeps the `_id` it was stored
    under and gets the generated one on its first insert.
    """
    want = evolve.wider(target.schema["doc"].dataType, delta.schema["doc"].dataType)
    target, delta = _fitted(target, want), _fitted(delta, want)
    j = _join(target, delta, on)
    changed = F.col("_d")
    gone = F.coalesce(changed & (F.col("d.op") == DELETE), F.lit(False))
    doc = F.when(changed, F.col("d.doc")).otherwise(F.col("t.doc"))
    out = [*_keys(on), doc.alias("doc")]
    if generated_id is not None:
        out.append(F.coalesce(F.col(f"t.{ID}"), generated_id).alias(ID))
    return j.filter(~gone).select(*out)


def insert_columns(rows: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add to a target the document fields that only the changes have, as nulls."""
    have, want = rows.schema["doc"].dataType, deltas.schema["cols"].dataType
    missing = [f for f in want.fields if f.name not in have.names]
    if not missing:
        return rows
    doc = F.col("doc")
    parts = [doc.getField(n).alias(n) for n in have.names]
    parts += [F.lit(None).cast(f.dataType["v"].dataType).alias(f.name) for f in missing]
    return rows.withColumn("doc", F.when(doc.isNotNull(), F.struct(*parts)))


def merge_columns(
    target: DataFrame, delta: DataFrame, on: Sequence[str] = ("k",), on_insert: Mapping[str, Column] | None = None
) -> DataFrame:
    """Apply `fold_columns` changes: written columns change, the others keep their value.

    `on_insert` gives columns set only when the row is created.
    """
    on_insert = dict(on_insert or {})
    target = insert_columns(target, delta)
    changed = delta.schema["cols"].dataType.names
    names = list(dict.fromkeys([*target.schema["doc"].dataType.names, *changed, *on_insert]))
    j = _join(target, delta, on)

    stays = F.col("_t").isNotNull() & F.col("d.reset").isNull()
    replaced = F.coalesce(F.col("d.reset") == REPLACE, F.lit(False))
    created = ~stays & F.coalesce(F.col("d.creates"), F.lit(False))
    counts = F.col("d.from_ord").isNull()

    stored, written = target.schema["doc"].dataType, delta.schema["cols"].dataType

    def value(name: str) -> Column:
        old = F.col("t.doc").getField(name) if name in stored.names else F.lit(None)
        if name in stored.names and name in changed:
            want = evolve.wider(stored[name].dataType, written[name].dataType["v"].dataType)
            old = evolve.fit(old, stored[name].dataType, want)
        elif name in changed:
            want = written[name].dataType["v"].dataType
        if name in on_insert:
            return F.when(stays, old).otherwise(on_insert[name])
        if name not in changed:
            return F.when(stays, old)
        new = F.col("d.cols").getField(name)
        last = evolve.fit(new.getField("v"), written[name].dataType["v"].dataType, want)
        kept = F.when(new.isNotNull(), last).otherwise(old)
        fresh = F.when(counts | (new.getField("ord") >= F.col("d.from_ord")), last)
        return F.when(stays, kept).otherwise(fresh)

    doc = F.struct(*[value(n).alias(n) for n in names])
    return j.filter(stays | replaced | created).select(*_keys(on), doc.alias("doc"))


def merge_fields(target: DataFrame, delta: DataFrame, on: Sequence[str] = ("k",)) -> DataFrame:
    """Apply `fold_fields` changes to JSON documents (`doc` is JSON text)."""
    j = _join(target, delta, on)
    stays = F.col("_t").isNotNull() & F.col("d.reset").isNull()
    replaced = F.coalesce(F.col("d.reset") == REPLACE, F.lit(False))
    created = ~stays & F.coalesce(F.col("d.creates"), F.lit(False))
    # only changed documents are parsed
    base = F.map_filter(
        jsontext.fields(F.col("t.doc")),
        lambda n, _: ~F.map_contains_key("d.sets", n) & ~F.array_contains("d.unsets", n),
    )
    doc = (
        F.when(F.col("_d").isNull(), F.col("t.doc"))
        .when(stays, jsontext.document(F.map_concat(base, F.col("d.sets"))))
        .otherwise(jsontext.document(F.col("d.sets")))
    )
    return j.filter(stays | replaced | created).select(*_keys(on), doc.alias("doc"))


BROADCAST_ROWS = 100_000
SALTS = 32


def after_offsets(log: DataFrame, applied: DataFrame, applied_rows: int) -> DataFrame:
    """Records above the last applied offset of their topic partition.

    `applied` holds one row per topic partition and is broadcast while its counted
    rows stay under BROADCAST_ROWS.  Beyond that it is copied SALTS times and joined on
    a salt too, as one partition may hold much of the log.
    """
    marks = applied.select("topic", "partition", F.col("offset").alias("_applied"))
    keys = ["topic", "partition"]
    if applied_rows <= BROADCAST_ROWS:
        j = log.join(F.broadcast(marks), keys, "left")
    else:
        salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        j = log.withColumn("_salt", F.pmod("offset", F.lit(SALTS).cast("bigint"))).join(
            marks.withColumn("_salt", salts), [*keys, "_salt"], "left"
        )
    fresh = F.col("_applied").isNull() | (F.col("offset") > F.col("_applied"))
    return j.filter(fresh).select(*log.columns)


def last_offsets(log: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Highest offset and time per topic partition, also counting what was applied before."""
    def marks(df: DataFrame) -> DataFrame:
        time = next((F.col(c) for c in ("time", "timestamp") if c in df.columns), F.lit(None))
        return df.select(*LOG_POSITION, time.cast("timestamp").alias("time"))

    seen = marks(log)
    if before is not None:
        seen = seen.unionByName(marks(before))
    return seen.groupBy("topic", "partition").agg(F.max("offset").alias("offset"), F.max("time").alias("time"))
