"""Patches that a store refuses, found before operations are reduced.

A patch is refused whole when one of its paths runs through a value that is no document.  Whether it
does depends on the writes before it that were not refused themselves, so refusals are settled
before the last write per path is taken: a refused patch must not replace an accepted one.

For every parent path that some patch of a key runs through, the log gives events: a write of that
path or of one above it changes what lies there, a patch through it asks.  A question is answered by the last
change before it that was not refused.  Changes by whole documents, and by patches that ask
nothing, stand from the start; others are settled in rounds, each of which settles at least the first open
patch of a key.  Only parents that hold a scalar at some time take part, which are few or none.

A key of up to `KEY_EVENTS` events is settled by one pass over them in order, with all other keys of its partition.
For longer ones running values are taken in blocks of a range partitioning by key, path and place, so that
a key that holds much of the log is not the work of one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidefold.functions import jsontext
from tidefold.functions.once import compute_once
from tidefold.model import REPLACE, SET
from tidefold.operators.fold_nested import SCALAR, prefixes
from tidefold.sinks.folders import shared_folder

# executors need no copy of this package for the pass over the events of a key
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPEN, STANDS, REFUSED, VOID = "open", "stands", "refused", "void"
KEY_EVENTS = 100_000


def holds_scalar(text: Column, path: Column) -> Column:
    """Whether something else than a document lies at a path (array of names) of a JSON value."""
    at = F.aggregate(path, text, lambda node, name: jsontext.fields(node)[name])
    return F.coalesce(~at.startswith("{"), F.lit(False))


def asked(ops_paths: Column) -> Column:
    """The parents that dotted paths run through."""
    parents = F.transform(F.filter(ops_paths, lambda p: p.contains(".")), lambda p: F.slice(prefixes(p), 2, F.size(F.split(p, r"\.")) - 1))
    return F.array_distinct(F.flatten(parents))


def _stored(df: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _large(df: DataFrame) -> DataFrame:
    """For a join: a file of a few MB may hold more rows than fit a broadcast, as keys and paths compress well."""
    return df.hint("merge")


def _changes(ops: DataFrame, parents: DataFrame) -> DataFrame:
    """(k, q, place, ask, change): what each operation asks of the parents of its key, and makes of them."""
    rows = ops.join(_large(parents), "k").select(
        "k", "ord", "op", "sets", "unsets", asked(F.concat(F.map_keys("sets"), "unsets")).alias("asks"), F.explode("parents").alias("q"))
    # the longest path of the operation that is the parent or above it
    above = F.filter(prefixes(F.col("q")), lambda a: F.map_contains_key("sets", a) | F.array_contains("unsets", a))
    hit = F.element_at(F.concat(F.array(F.lit(None).cast("string")), above), -1)
    is_set = F.col("op") == SET
    at = F.when(is_set, hit).otherwise(F.split("q", r"\.")[0])
    rows = compute_once(rows, at=at).withColumn("text", F.col("sets")[F.col("at")])
    names = F.split("q", r"\.")
    inside = F.slice(names, F.size(F.split("at", r"\.")) + 1, F.greatest(F.size(names) - F.size(F.split("at", r"\.")), F.lit(0)))
    scalar = holds_scalar(F.col("text"), F.when(F.col("at").isNotNull(), inside).otherwise(F.array().cast("array<string>")))
    rows = compute_once(rows, scalar=scalar)
    return rows.select(
        "k", "q", F.struct(F.lit(1).alias("after"), F.col("ord").alias("ord")).alias("place"),
        (is_set & F.array_contains("asks", F.col("q"))).alias("ask"),
        F.when(~is_set | F.col("at").isNotNull(), F.col("scalar")).alias("change"), "op",
    ).filter("ask OR change IS NOT NULL")


def _in_blocks(df: DataFrame, name: str) -> DataFrame:
    """The rows stored with `block`, which grows with (k, q, place)."""
    return _stored(df.repartitionByRange("k", "q", "place").withColumn("block", F.spark_partition_id()), name)


def _last(df: DataFrame, value: Column, group: list[str]) -> DataFrame:
    """Add `last`, the greatest `value` up to the row; values grow with `place`."""
    df = df.withColumn("_v", value)
    inside = Window.partitionBy(*group, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy(*group, "block").agg(F.max("_v").alias("_top")).select(*group, "block", F.max("_top").over(along).alias("_before"))
    inner = df.withColumn("_in", F.max("_v").over(inside)).join(blocks, [*group, "block"])
    return inner.withColumn("last", F.greatest("_in", "_before")).drop("_v", "_in", "_before")


def _differs(column: pa.Array) -> np.ndarray:
    """Whether a row has another value than the row before; the first one counts as different."""
    if pa.types.is_struct(column.type):
        return np.logical_or.reduce([_differs(c) for c in column.flatten()])
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    values = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return np.concatenate([[True], values | (valid[1:] != valid[:-1])])


class _Key:
    """What patches so far have made of the parents of a key; the events of one operation come in a row."""

    def __init__(self):
        self.there, self.scalars, self.events = False, {}, []

    def settled(self) -> bool:
        """End the operation whose events were gathered: whether it is a patch that is refused."""
        events, self.events = self.events, []
        if not events:
            return False
        is_set, replaces = events[0][3:]
        if not is_set:
            self.there = replaces
        elif not self.there:  # patches of a document that is not there do nothing
            return False
        elif any(ask and (change or (change is None and self.scalars.get(q))) for q, ask, change, _, _ in events):
            return True
        self.scalars.update((q, change) for q, _, change, _, _ in events if change is not None)
        return False


def _pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, ord) of the refused patches, from events that are sorted by key and place."""
    key, before = _Key(), None

    def rows(part: pa.RecordBatch, places: list[int]) -> pa.RecordBatch:
        of = part.take(pa.array(places, pa.int64()))
        return pa.RecordBatch.from_arrays([of["k"], of["ord"]], ["k", "ord"])

    for part in parts:
        if not part.num_rows:
            continue
        new_key, new_place = _differs(part["k"]), _differs(part["after"]) | _differs(part["ord"])
        if before is not None:
            same = lambda c: before[c][-1].as_py() == part[c][0].as_py()
            new_key[0] = not same("k")
            new_place[0] = not (same("after") and same("ord"))
        bad = []
        columns = [part[c].to_pylist() for c in ("q", "ask", "change", "is_set", "replaces")]
        for n, (another, starts, *event) in enumerate(zip(new_key.tolist(), (new_key | new_place).tolist(), *columns)):
            if starts and key.settled():
                if n:
                    bad.append(n - 1)
                else:
                    yield rows(before, [before.num_rows - 1])
            if another:
                key = _Key()
            key.events.append(event)
        yield rows(part, bad)
        before = part
    if key.settled():
        yield rows(before, [before.num_rows - 1])


def _in_order(events: DataFrame) -> DataFrame:
    """The refused patches of keys with few events."""
    ordered = events.select(
        "k", "place.after", "place.ord", "q", "ask", "change", (F.col("op") == SET).alias("is_set"), (F.col("op") == REPLACE).alias("replaces"))
    schema = T.StructType([events.schema["k"], T.StructField("ord", events.schema["place"].dataType["ord"].dataType)])
    return ordered.repartition("k").sortWithinPartitions("k", "after", "ord").mapInArrow(_pass, schema)


def refused(ops: DataFrame, base: DataFrame | None = None) -> DataFrame | None:
    """(k, ord) of the refused patches, None where there are none; `base` (k, doc) is what the target holds."""
    ops = ops.select("k", "ord", "op", "sets", "unsets")
    patches = ops.filter(F.col("op") == SET).select("k", F.explode(asked(F.concat(F.map_keys("sets"), "unsets"))).alias("q"))
    parents = _stored(patches.groupBy("k").agg(F.collect_set("q").alias("parents")), "patch-parents")
    if parents.isEmpty():
        return None
    events = _changes(ops, parents)
    start = events.select("k", "q", "place").limit(0).select("k", "q", "place", F.lit(False).alias("scalar"))
    if base is not None:
        held = base.join(_large(parents), "k").select("k", "doc", F.explode("parents").alias("q"))
        nowhere = F.lit(None).cast(ops.schema["ord"].dataType)
        start = held.select("k", "q", F.struct(F.lit(0).alias("after"), nowhere.alias("ord")).alias("place"),
                            holds_scalar(F.col("doc"), F.split("q", r"\.")).alias("scalar"))
    start = start.select("k", "q", "place", F.lit(False).alias("ask"), F.col("scalar").alias("change"), F.lit(REPLACE).alias("op"))
    # stored first: a range partitioning samples its input, which would read all documents again
    events = _stored(events.unionByName(start), "patch-events")
    scalars = events.groupBy("k", "q").agg(F.max("change").alias("scalar"), F.count(F.lit(1)).alias("n"))
    scalars = _stored(scalars.filter("scalar").select("k", "q", "n"), "patch-scalars")
    if scalars.isEmpty():
        return None
    events = events.join(_large(scalars.select("k", "q")), ["k", "q"], "left_semi")
    # as many keys as events over `KEY_EVENTS` at most
    long = _stored(scalars.groupBy("k").agg(F.sum("n").alias("n")).filter(F.col("n") > KEY_EVENTS).select("k"), "patch-long-keys")
    if long.isEmpty():
        return _stored(_in_order(events), "patches-refused")
    few = _stored(_in_order(events.join(long, "k", "left_anti")), "patches-refused")
    return few.unionByName(_in_rounds(events.join(long, "k", "left_semi")))


def _in_rounds(events: DataFrame) -> DataFrame:
    """The refused patches of keys with many events."""
    events = _in_blocks(events, "patch-events")
    # patches of a document that is not there do nothing
    there = F.when(F.col("op") != SET, F.struct("place", (F.col("op") == REPLACE).alias("is")))
    events = _last(events, there, ["k", "q"]).withColumn("there", F.coalesce(F.col("last.is"), F.lit(False))).drop("last")
    events = _stored(events, "patch-events")
    own = F.max(F.col("ask") & F.coalesce("change", F.lit(False)))
    status = events.groupBy("k", "place").agg(F.max("ask").alias("ask"), F.max("there").alias("there"), own.alias("own"), F.min("op").alias("op"))
    first = F.when(F.col("op") != SET, STANDS).when(~F.col("there"), VOID).when(F.col("own"), REFUSED).when(F.col("ask"), OPEN).otherwise(STANDS)
    status = _stored(status.select("k", "place", first.alias("status")), "patch-status")
    while not status.filter(F.col("status") == OPEN).isEmpty():
        live = events.join(status, ["k", "place"])
        made = F.when(F.col("change").isNotNull() & F.col("status").isin(STANDS, OPEN), F.struct("place", "status", "change"))
        seen = _last(live, made, ["k", "q"]).filter((F.col("status") == OPEN) & F.col("ask") & F.col("change").isNull())
        bad = F.coalesce((F.col("last.status") == STANDS) & F.col("last.change"), F.lit(False))
        unknown = F.coalesce(F.col("last.status") == OPEN, F.lit(False)) & (F.col("last.place") < F.col("place"))
        told = seen.groupBy("k", "place").agg(F.max(bad).alias("bad"), F.max(unknown).alias("unknown"))
        settled = F.when(F.col("status") != OPEN, F.col("status")).when(F.col("bad"), REFUSED).when(F.col("unknown"), OPEN).otherwise(STANDS)
        status = _stored(status.join(told, ["k", "place"], "left").select("k", "place", settled.alias("status")), "patch-status")
    return status.filter(F.col("status") == REFUSED).select("k", F.col("place.ord").alias("ord"))


def with_refusals(ops: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Operations with the reason of refused patches in `err`."""
    bad = refused(ops, base)
    known = F.col("err") if "err" in ops.columns else F.lit(None).cast("string")
    if bad is None:
        return ops.withColumn("err", known)
    bad = bad.withColumn("_refused", F.lit(SCALAR))
    return ops.join(_large(bad), ["k", "ord"], "left").withColumn("err", F.coalesce(known, "_refused")).drop("_refused")
