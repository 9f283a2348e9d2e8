"""Field projection by black- and whitelists of dotted paths with wildcards.

A matcher answers, for one field of one level, whether the field stays and which
matcher holds below it (None: keep everything below).  The walker turns these
answers into column expressions, so Catalyst can prune the dropped leaves from
the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions.walk import DOC, DOCS, LEAF, as_struct, kind, null_of
from tidefold.model import ID

ANY, DEEP = "*", "**"


def split_paths(rules: str | Iterable[str]) -> list[tuple[str, ...]]:
    """`a, b.c` or ["a", "b.c"] to path tuples."""
    items = rules.split(",") if isinstance(rules, str) else rules
    return [tuple(r.strip().split(".")) for r in items if r.strip()]


@dataclass(frozen=True)
class Blacklist:
    rules: tuple[tuple[str, ...], ...]

    @staticmethod
    def of(rules: str | Iterable[str]) -> "Blacklist":
        return Blacklist(tuple(split_paths(rules)))

    def root(self) -> "Blacklist | None":
        return self if self.rules else None

    def child(self, name: str, shape: str) -> tuple[bool, "Blacklist | None"]:
        below = []
        for head, *rest in self.rules:
            if head == name:
                if not rest and name != ID:
                    return False, None
                if rest and shape != LEAF:
                    below.append(tuple(rest))
            elif name == ID:
                continue
            elif head == DEEP or (head == ANY and shape != DOC):
                return False, None
            elif head == ANY and rest:
                below.append(tuple(rest))
        return True, Blacklist(tuple(below)) if below else None

    def names(self) -> set[str]:
        return {r[0] for r in self.rules} - {ANY, DEEP}


@dataclass(frozen=True)
class Whitelist:
    paths: frozenset[tuple[str, ...]]
    at: tuple[str, ...] = ()

    @staticmethod
    def of(rules: str | Iterable[str]) -> "Whitelist":
        """Listing a path lists all its parents too."""
        return Whitelist.exactly(p[:n] for p in split_paths(rules) for n in range(1, len(p) + 1))

    @staticmethod
    def exactly(paths: Iterable[tuple[str, ...]]) -> "Whitelist":
        return Whitelist(frozenset(paths))

    def root(self) -> "Whitelist | None":
        return None if (DEEP,) in self.paths else self

    def child(self, name: str, shape: str) -> tuple[bool, "Whitelist | None"]:
        here = self.at + (name,)
        listed = here == (ID,) or any(
            len(p) == len(here) and all(a in (ANY, b) for a, b in zip(p, here)) for p in self.paths
        )
        whole = shape == LEAF or (shape == DOC and here + (DEEP,) in self.paths)
        return listed, None if whole else Whitelist(self.paths, here)

    def names(self) -> set[str]:
        depth = len(self.at)
        return {p[depth] for p in self.paths if len(p) > depth} - {ANY, DEEP}


Matcher = Blacklist | Whitelist


def project_column(
    col: Column, dtype: T.DataType, matcher: Matcher | None, keep_empty: bool = False, keep_shape: bool = False
) -> Column | None:
    """The projected column, or None when nothing of a document is left.

    `keep_empty` keeps such documents as empty structs.  `keep_shape` nulls dropped
    struct fields instead of removing them (map values must share one type).
    """
    if matcher is None:
        return col
    opts = dict(keep_empty=keep_empty, keep_shape=keep_shape)
    if isinstance(dtype, T.StructType):
        parts = []
        for f in dtype.fields:
            stays, below = matcher.child(f.name, kind(f.dataType))
            part = project_column(col.getField(f.name), f.dataType, below, **opts) if stays else None
            if part is None and keep_shape:
                part = null_of(f.dataType)
            if part is not None:
                parts.append(part.alias(f.name))
        return as_struct(col, parts) if parts or keep_empty else None
    if isinstance(dtype, T.ArrayType):
        if kind(dtype) != DOCS:
            return col
        if project_column(col, dtype.elementType, matcher, **opts) is None:
            return None
        return F.transform(col, lambda x: project_column(x, dtype.elementType, matcher, **opts))
    if isinstance(dtype, T.MapType):
        return _project_map(col, dtype, matcher, keep_empty)
    return col


def _project_map(col: Column, dtype: T.MapType, matcher: Matcher, keep_empty: bool) -> Column:
    """Map entries are fields whose names are known at run time only."""
    shape = kind(dtype.valueType)
    named = sorted(matcher.names() | {ID})
    answers = {n: matcher.child(n, shape) for n in named}
    # a name no rule spells out: only wildcards can speak about it
    other = matcher.child("\0", shape)

    keep = lambda k, _: _by_key(k, {n: F.lit(a[0]) for n, a in answers.items()}, F.lit(other[0]))
    kept = F.map_filter(col, keep)
    if shape == LEAF:
        return kept

    below = {n: a[1] for n, a in answers.items() if a[0]}
    opts = dict(keep_empty=keep_empty, keep_shape=True)

    def values(k, v):
        down = lambda m: project_column(v, dtype.valueType, m, **opts)
        return _by_key(k, {n: down(m) for n, m in below.items()}, down(other[1]))

    if all(m is None for m in [*below.values(), other[1]]):
        return kept
    return F.transform_values(kept, values)


def _by_key(k: Column, cases: dict[str, Column], default: Column) -> Column:
    out = None
    for name, value in cases.items():
        out = F.when(k == name, value) if out is None else out.when(k == name, value)
    return default if out is None else out.otherwise(default)


def project(df: DataFrame, column: str, matcher: Matcher | None, keep_empty: bool = False) -> DataFrame:
    """Project the document held in `column`."""
    top = matcher.root() if matcher else None
    if top is None:
        return df
    if not isinstance(df.schema[column].dataType, (T.StructType, T.MapType)):
        raise ValueError(f"{column} holds no fields that could be projected: decode it with a schema first")
    out = project_column(F.col(column), df.schema[column].dataType, top, keep_empty)
    if out is None:
        out = F.when(F.col(column).isNotNull(), F.struct())
    return df.withColumn(column, out)


PROJECTIONS = {"blacklist": Blacklist.of, "whitelist": Whitelist.of}


def projection(kind_name: str, rules: str | Iterable[str]) -> Matcher | None:
    """Matcher of a configured projection type: none, blacklist or whitelist."""
    name = kind_name.lower()
    if name == "none":
        return None
    if name not in PROJECTIONS:
        raise ValueError(f"unknown projection type {kind_name!r}")
    return PROJECTIONS[name](rules)
