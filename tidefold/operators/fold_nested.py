"""Patches that address nested fields by dotted paths.

The last write per (key, path) is all that can matter: a younger write of a path
undoes every older one of it.  That reduction has a map-side part, so what is left
of a key is one row per path ever written, however hot the key is.

From there, either the live leaves are told apart by rule (`fold_paths`): every
write leaves a marker at its path, and a leaf lives when no marker on it or on one
of its parents is younger.  Or the writes of a key are applied, in order, to the
document a target holds (`merge_paths`).
"""

from __future__ import annotations

import json
import sys
from itertools import groupby

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidefold.functions.once import compute_once
from tidefold.model import REPLACE, SET
from tidefold.operators.errors import add_error

# executors need no copy of this package for the small functions below
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROOT, UNSET = "", "unset"
LEAVES = "array<struct<path:string,value:string>>"
SCALAR = "path runs through a scalar"


class _Number(str):
    """A JSON number, in its spelling."""


class _Parser:
    """json.loads that keeps numbers' spelling; one decoder for all calls, which executors make anew."""

    def __init__(self):
        self.decode = json.JSONDecoder(parse_float=_Number, parse_int=_Number).decode

    def __call__(self, text: str):
        return self.decode(text)

    def __reduce__(self):
        return _Parser, ()


parsed = _Parser()
_quoted = json.encoder.encode_basestring


def _text(node) -> str:
    """Canonical text; numbers are written as they were read."""
    if isinstance(node, _Number):
        return str(node)
    if isinstance(node, str):
        return _quoted(node)
    if isinstance(node, dict):
        return "{" + ",".join(f"{_quoted(k)}:{_text(node[k])}" for k in sorted(node)) + "}"
    if isinstance(node, list):
        return "[" + ",".join(map(_text, node)) + "]"
    return json.dumps(node, ensure_ascii=False)


def _leaves(node, path: str, out: list) -> list:
    if isinstance(node, dict) and node:
        for name, child in node.items():
            _leaves(child, f"{path}.{name}" if path else name, out)
    else:
        out.append((path, _text(node)))
    return out


def _leaves_of_batch(paths: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _leaves(parsed(t), p, []) for p, t in zip(paths, texts)])


def _write(doc: dict, path: str, text: str | None, parents_exist: bool = True) -> str | None:
    """Set a path, or remove it where there is no text; tells why it cannot."""
    *parents, last = path.split(".")
    at = doc
    for name in parents:
        if name not in at:
            break
        at = at[name]
        if not isinstance(at, dict):
            return SCALAR
    for name in parents:
        if name not in doc and not parents_exist:
            return None
        doc = doc.setdefault(name, {})
    if text is None:
        doc.pop(last, None)
    else:
        doc[last] = parsed(text)
    return None


def _parents(path: str) -> list[str]:
    names = path.split(".")
    return [ROOT, *(".".join(names[:n]) for n in range(1, len(names)))]


def _applied(text: str | None, writes) -> tuple[str | None, str | None]:
    """The document after the writes; the writes of one operation apply together or not at all.

    Writes below a path that is written later are gone.  A path that was set and removed again leaves its parents.
    """
    doc, err = (None if text is None else parsed(text)), None
    place = {w["path"]: w["nth"] for w in writes}
    above = lambda w: max((place[p] for p in _parents(w["path"]) if w["path"] != ROOT and p in place), default=0)
    for _, together in groupby([w for w in writes if above(w) <= w["nth"]], key=lambda w: w["nth"]):
        together = list(together)
        if together[0]["path"] == ROOT:
            doc = {} if together[0]["act"] == REPLACE else None
        if doc is None:
            continue
        patch = [w for w in together if w["path"] != ROOT]
        before = _text(doc) if len(patch) > 1 else None
        for w in patch:
            stay = w["text"] is not None or (w["made"] is not None and w["made"] >= above(w))
            bad = _write(doc, w["path"], w["text"], stay)
            if bad:
                err = bad
                doc = parsed(before) if before is not None else doc
                break
    return (None if doc is None else _text(doc)), err


def _apply_batch(docs: pd.Series, writes: pd.Series) -> pd.DataFrame:
    done = [(d, None) if w is None else _applied(d, json.loads(w)) for d, w in zip(docs, writes)]
    return pd.DataFrame(done, columns=["doc", "err"])


def leaves(path: Column | str, text: Column | str) -> Column:
    """Leaf paths and values of a JSON value set at a path; arrays count as leaves."""
    return F.pandas_udf(_leaves_of_batch, LEAVES)(path, text)


def check_paths(ops: DataFrame) -> DataFrame:
    """Numeric path parts address array elements, which patches here cannot."""
    paths = F.concat(F.map_keys("sets"), "unsets")
    numeric = F.exists(paths, lambda p: p.rlike(r"(^|\.)\d+(\.|$)"))
    return add_error(ops, F.when((F.col("op") == SET) & numeric, F.lit("path addresses an array element")))


def prefixes(path: Column) -> Column:
    """The path and all its parents, the root included."""
    parts = F.split(path, r"\.")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    return F.concat(F.array(F.lit(ROOT)), heads)


def written_paths(ops: DataFrame) -> DataFrame:
    """Last write per (key, path): a whole document counts as a write of the root and of its fields."""
    row = lambda path, act, text: F.struct(path.alias("path"), act.alias("act"), text.alias("text"))
    no_text = F.lit(None).cast("string")
    root = F.when(F.col("op") != SET, row(F.lit(ROOT), F.col("op"), no_text))
    events = F.concat(
        F.filter(F.array(root), lambda r: r.isNotNull()),
        F.transform(F.map_entries("sets"), lambda e: row(e["key"], F.lit(SET), e["value"])),
        F.transform(
            F.filter("unsets", lambda p: ~F.map_contains_key("sets", p)), lambda p: row(p, F.lit(UNSET), no_text)
        ),
    )
    return (
        ops.select("k", "ord", F.explode(events).alias("e"))
        .groupBy("k", F.col("e.path").alias("path"))
        .agg(F.max("ord").alias("ord"), F.max_by(F.struct("e.act", "e.text"), "ord").alias("last"),
             F.max(F.when(F.col("e.act") == SET, F.col("ord"))).alias("made"))
        .select("k", "path", "ord", "last.act", "last.text", "made")
    )


def fold_paths(ops: DataFrame) -> DataFrame:
    """Live leaves of every key after folding into an empty target: k, path, value, ord."""
    writes = written_paths(ops).withColumn("leaves", leaves("path", "text"))
    # each write gives its marker, and each of its leaves once per parent to meet their markers
    row = lambda at, path, value: F.struct(at.alias("at"), path.alias("path"), value.alias("value"))
    no_text = F.lit(None).cast("string")
    under = lambda l: F.transform(prefixes(l["path"]), lambda p: row(p, l["path"], l["value"]))
    marker = F.array(row(F.col("path"), no_text, no_text))
    rows = F.concat(marker, F.coalesce(F.flatten(F.transform("leaves", under)), F.array().cast(
        "array<struct<at:string,path:string,value:string>>")))
    met = writes.select("k", "ord", "act", F.explode(rows).alias("r")).select("k", "ord", "act", "r.*")

    place, is_mark = Window.partitionBy("k", "at"), F.col("path").isNull()
    judged = met.select(
        "k", "at", "path", "value", "ord",
        F.max(F.when(is_mark, F.col("ord"))).over(place).alias("mark"),
        F.max(F.when(is_mark & (F.col("at") == ROOT), F.col("act"))).over(place).alias("root"),
    )
    live = judged.filter("path IS NOT NULL").groupBy("k", "path", "ord").agg(
        F.first("value").alias("value"), F.max("mark").alias("mark"), F.max("root").alias("root")
    )
    # patches do nothing where there is no document: the last write of the root must be one
    alive = (F.col("root") == REPLACE) & (F.col("mark") <= F.col("ord"))
    return live.filter(alive).select("k", "path", "value", "ord")


def fold_writes(ops: DataFrame) -> DataFrame:
    """One row per key: the writes that can still matter, in the order they apply."""
    key, root = Window.partitionBy("k"), F.when(F.col("path") == ROOT, F.col("ord"))
    left = written_paths(ops).withColumn("reset_ord", F.max(root).over(key))
    left = left.filter(F.col("reset_ord").isNull() | (F.col("ord") >= F.col("reset_ord")))
    ordered = F.sort_array(F.collect_list(F.struct("ord", "path", "act", "text", "made")))
    # the paths of one operation share its place
    ords = F.concat(F.transform("w", lambda x: x["ord"]), F.filter(F.transform("w", lambda x: x["made"]), lambda o: o.isNotNull()))
    write = lambda x: F.struct(
        x["path"].alias("path"), x["act"].alias("act"), x["text"].alias("text"),
        F.array_position("places", x["ord"]).alias("nth"),
        F.when(x["made"].isNotNull(), F.array_position("places", x["made"])).alias("made"),
    )
    return left.groupBy("k").agg(ordered.alias("w")).withColumn("places", F.array_sort(F.array_distinct(ords))).select(
        "k", F.transform("w", write).alias("writes")
    )


# what is written as it was read: plain names, and scalars without escapes
PLAIN_NAME, PLAIN_TEXT = r"^[A-Za-z0-9_ -]+\z", r'^("[^"\\\x00-\x1f]*"|-?[0-9][0-9.eE+-]*|true|false|null)\z'


def whole_document(writes: Column) -> Column:
    """The text of a document whose writes are those of one replacement with plain fields; null for other writes."""
    root, written = writes[0], F.slice(writes, 2, F.greatest(F.size(writes) - 1, F.lit(0)))
    plain = lambda w: F.coalesce(
        (w["act"] == SET) & (w["nth"] == root["nth"]) & w["path"].rlike(PLAIN_NAME) & w["text"].rlike(PLAIN_TEXT), F.lit(False))
    one = (F.size(writes) > 0) & (root["path"] == ROOT) & (root["act"] == REPLACE) & F.forall(written, plain)
    field = lambda w: F.concat(F.lit('"'), w["path"], F.lit('":'), w["text"])
    return F.when(one, F.concat(F.lit("{"), F.array_join(F.transform(written, field), ","), F.lit("}")))


def merge_paths(target: DataFrame, delta: DataFrame, on: tuple[str, ...] = ("k",)) -> DataFrame:
    """Apply `fold_writes` changes to JSON documents: the keys, `doc` and `err`.

    A write through a scalar is left out and named in `err`, as the store refuses it.
    """
    j = target.select(*on, "doc").join(delta.select(*on, "writes"), list(on), "full_outer")
    # documents without a change and whole ones of plain fields pass beside Python, not through it; writes as texts cost less to pass than arrays of structs
    j = compute_once(j, whole=whole_document(F.col("writes")))
    has_change = F.col("writes").isNotNull() & F.col("whole").isNull()
    texts = F.when(has_change, F.to_json("writes", {"ignoreNullFields": "false"}))
    applied = F.pandas_udf(_apply_batch, "doc string, err string")(F.when(has_change, F.col("doc")), texts)
    # the filters on doc and err would each run the function again
    merged = compute_once(j, a=applied)
    doc = F.when(has_change, F.col("a.doc")).otherwise(F.coalesce("whole", "doc"))
    return merged.select(*on, doc.alias("doc"), F.col("a.err").alias("err")).filter("doc IS NOT NULL")
