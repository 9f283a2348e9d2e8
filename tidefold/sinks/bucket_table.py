"""Parquet targets with a primary key, rewritten bucket by bucket.

Spark cannot overwrite files it reads, and plain Parquet has no MERGE.  A change
therefore writes new versions of the buckets it touches and then publishes a
manifest that names the version of every bucket.  Readers see the last manifest
only; a version that was not published is overwritten by the next attempt.

    <path>/data/v=<version>/_bucket=<b>/...    rows
    <path>/offsets/v=<version>/...             last applied offset per topic partition
    <path>/manifest/v=<version>/...            one JSON text

Rows are spread by a hash of their unique key, so buckets stay even.  A bucket that is more than one task's
work is cut into several tasks, each of which writes a file of it: a task's memory does not grow with the
table.  Size the number of buckets by what a small batch should rewrite (some 256 MB each).

The changes of a batch are stored before they are merged, and where they and the stored rows are many, buckets
or parts of them are merged in turns: what is shuffled lies on disk for one turn only, beside the old version and the new.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from hashlib import sha256
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidefold.operators.evolve import grow
from tidefold.operators.merge import last_offsets
from tidefold.sinks import folders

BUCKET = "_bucket"
OFFSETS = "topic string, partition int, offset bigint, time timestamp"
# what a task merges, of the changes and the stored rows together: rows, and bytes as JSON text
TASK_ROWS, TASK_BYTES = 500_000, 128 << 20
TURN_ROWS = 10_000_000  # rows that are shuffled at once for a merge
PACKING = "zstd"  # hashed keys are most of a row of a table without key
PACKED = 4  # bytes of JSON text per byte of a Parquet file, roughly
WIDTHS = 16  # one key in so many is measured for the mean width of rows; only the number of tasks depends on it
REJECTS = "topic string, partition int, offset bigint, k string, err string, key string, value string"

Merge = Callable[[DataFrame, DataFrame], DataFrame]
# (target, operations) to (changes, what cannot be merged)
Resolve = Callable[[DataFrame | None, DataFrame], tuple[DataFrame, DataFrame | None]]


@dataclass(frozen=True)
class Manifest:
    """What readers see.

    `buckets` gives per bucket its version and the schema it was written with,
    `applied` the last batch of each source (a source is one checkpoint: a new one
    counts its batches from 0 again), `offsets` the version that recorded offsets,
    `count` and `keys` how rows are dealt to buckets.
    """

    version: int
    schema: str
    buckets: dict[int, tuple[int, str]]
    applied: dict[str, int]
    count: int
    keys: list[str]
    offsets: int | None = None

    def text(self) -> str:
        schemas = sorted({s for _, s in self.buckets.values()})
        buckets = {b: (v, schemas.index(s)) for b, (v, s) in sorted(self.buckets.items())}
        return json.dumps({**self.__dict__, "schemas": schemas, "buckets": buckets})

    @staticmethod
    def of(text: str) -> "Manifest":
        m = json.loads(text)
        schemas = m.pop("schemas")
        m["buckets"] = {int(b): (v, schemas[s]) for b, (v, s) in m["buckets"].items()}
        return Manifest(**m)


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


@dataclass(frozen=True)
class BucketTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 15
    rows_per_file: int = 0

    def bucket(self) -> Column:
        """The partition a shuffle by the key would give the row: then one task holds rows of one bucket only."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).alias(BUCKET)

    def by_bucket(self, df: DataFrame, tasks: int = 1) -> DataFrame:
        """The rows dealt to `tasks` partitions per bucket: their number is a multiple of the buckets, so none holds two."""
        return df.repartition(self.buckets * tasks, *self.keys)

    def _tasks(self, counted: Sequence, held: int, before: Manifest | None) -> int:
        """Tasks per bucket, from what is counted of the changes per bucket and the number and size of the stored rows."""
        rows = held + sum(r["n"] for r in counted)
        measured = sum(r["measured"] for r in counted)
        size = rows * sum(r["width"] or 0 for r in counted) / max(1, measured)
        if before is not None:
            for r in counted:
                if r[BUCKET] in before.buckets:
                    size += PACKED * folders.size(self.spark, f"{self.path}/data/v={before.buckets[r[BUCKET]][0]}/{BUCKET}={r[BUCKET]}")
        share = max(1, len(counted))
        return max(1, ceil(rows / share / TASK_ROWS), ceil(size / share / TASK_BYTES))

    # -- reading ------------------------------------------------------------

    def manifest(self) -> Manifest | None:
        base = f"{self.path}/manifest"
        done = [
            int(n.split("=")[1])
            for n in folders.children(self.spark, base)
            if folders.exists(self.spark, f"{base}/{n}/_SUCCESS")
        ]
        if not done:
            return None
        text = self.spark.read.text(f"{base}/v={max(done)}", wholetext=True).first()[0]
        m = Manifest.of(text)
        if (m.count, m.keys) != (self.buckets, list(self.keys)):
            raise ValueError(f"the table has {m.count} buckets by {m.keys}, not {self.buckets} by {list(self.keys)}")
        return m

    def schema(self) -> T.StructType | None:
        m = self.manifest()
        return T.StructType.fromJson(json.loads(m.schema)) if m else None

    def read(
        self, buckets: Sequence[int] | None = None, with_bucket: bool = False, at: Manifest | None = None
    ) -> DataFrame | None:
        """Current rows, of the given buckets only if any are named; None before the first write."""
        m = at or self.manifest()
        if m is None:
            return None
        want = T.StructType.fromJson(json.loads(m.schema))
        chosen = m.buckets if buckets is None else {b: m.buckets[b] for b in buckets if b in m.buckets}
        by_schema: dict[str, list[str]] = {}
        for b, (version, schema) in sorted(chosen.items()):
            by_schema.setdefault(schema, []).append(f"{self.path}/data/v={version}/{BUCKET}={b}")
        parts = [self._load(schema, paths, want) for schema, paths in by_schema.items()]
        df = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], _with_bucket(want))
        return df if with_bucket else df.drop(BUCKET)

    def _load(self, schema: str, paths: list[str], want: T.StructType) -> DataFrame:
        stored = T.StructType.fromJson(json.loads(schema))
        typed = _with_bucket(T.StructType([*stored.fields, T.StructField("v", T.LongType())]))
        df = self.spark.read.schema(typed).option("basePath", f"{self.path}/data").parquet(*paths).drop("v")
        return grow(df, _with_bucket(want))

    def offsets(self, at: Manifest | None = None) -> DataFrame | None:
        """Last applied offset and time per topic partition; None when none were recorded."""
        m = at or self.manifest()
        if m is None or m.offsets is None:
            return None
        return self.spark.read.schema(OFFSETS).parquet(f"{self.path}/offsets/v={m.offsets}")

    # -- writing ------------------------------------------------------------

    def apply(
        self, delta: DataFrame, merge: Merge, batch: int, log: DataFrame | None = None, source: str = "",
        resolve: Resolve | None = None,
    ) -> None:
        """Merge one change per key into the table and publish the result.

        `resolve(target, delta)` makes the changes of operations that depend on what the target holds, and
        gives those that cannot be merged with their reasons; they are written to the table's rejects first.

        `merge(target, delta)` joins on the key; its target is None before the first write.
        A batch its source has applied before is passed over.  `log` are the records the
        changes came from; their offsets are recorded with the batch.
        """
        before = self.manifest()
        if before and before.applied.get(source, -1) >= batch:
            return
        folder = folders.shared_folder(self.spark, "changes")
        try:
            delta.write.option("compression", PACKING).parquet(folder)
            delta = self.spark.read.schema(delta.schema).parquet(folder)
            width = F.when(F.pmod(F.xxhash64(*self.keys), F.lit(WIDTHS)) == 0, F.length(F.to_json(F.struct(*delta.columns))))
            counted = delta.select(self.bucket(), width.alias("w")).groupBy(BUCKET).agg(
                F.count(F.lit(1)).alias("n"), F.count("w").alias("measured"), F.sum("w").alias("width")).collect()
            touched = sorted(r[BUCKET] for r in counted)
            base = self.read(touched, at=before) if before else None
            held = base.count() if before else 0
            tasks = self._tasks(counted, held, before)
            changes = delta
            if resolve is not None:
                changes, bad = resolve(base, delta)
                if bad is not None:
                    self.reject(bad, batch, source, "merge")
            turns = max(1, ceil((held + sum(r["n"] for r in counted)) / TURN_ROWS))
            cuts = max(1, ceil(turns / max(1, len(touched))))  # of a bucket

            def merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
                dealt = lambda df: self.by_bucket(df, ceil(tasks / cuts))
                return merge(None if old is None else dealt(old), dealt(new))

            def turn(buckets: list[int], cut: int) -> DataFrame:
                mine = F.pmod(F.xxhash64(*self.keys), F.lit(cuts)) == cut
                old = None if before is None else self.read(buckets, at=before).filter(mine)
                return merged(old, changes.filter(self.bucket().isin(buckets) & mine))

            if turns == 1:
                parts = [merged(base, changes)]
            else:
                groups = min(turns, len(touched))
                parts = [turn(touched[n::groups], cut) for n in range(groups) for cut in range(cuts)]
            self._publish(parts, touched, before, {source: batch}, log)
        finally:
            folders.remove(self.spark, folder)

    def reject(self, rows: DataFrame, batch: int, source: str, stage: str) -> None:
        """Write rejects of a batch; a batch that is tried again replaces its own."""
        have = dict(rows.dtypes)
        text = lambda c: F.col(c) if have[c] in ("string", "int", "bigint") else F.to_json(c)
        columns = [(text(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                   for f in T.StructType.fromDDL(REJECTS)]
        of = sha256(source.encode()).hexdigest()[:12]
        path = f"{self.path}/rejected/source={of}/batch={batch}/stage={stage}"
        rows.select(*columns).write.mode("overwrite").parquet(path)

    def rejected(self) -> DataFrame:
        """Rejected records and changes, with their reasons."""
        path = f"{self.path}/rejected"
        if not folders.exists(self.spark, path):
            return self.spark.createDataFrame([], REJECTS)
        return self.spark.read.schema(REJECTS).option("recursiveFileLookup", "true").parquet(path)

    def overwrite(self, rows: DataFrame) -> None:
        """Replace all rows."""
        before = self.manifest()
        self._publish([self.by_bucket(rows)], list(before.buckets) if before else [], before, {}, None)

    def truncate(self, forget_applied: bool = True) -> None:
        """Drop all rows and keep the schema; a log that was applied can then be applied again."""
        before = self.manifest()
        if before is not None:
            applied, offsets = ({}, None) if forget_applied else (before.applied, before.offsets)
            self._write_manifest(
                replace(before, version=before.version + 1, buckets={}, applied=applied, offsets=offsets)
            )

    def rebucketed(self, buckets: int, path: str) -> "BucketTable":
        """The rows as a table of another number of buckets at another path."""
        out, before = replace(self, path=path, buckets=buckets), self.manifest()
        if before is not None:
            marks = self.offsets(before)
            out._publish([out.by_bucket(self.read(at=before))], [], None, before.applied, marks)
        return out

    def _publish(self, parts: Sequence[DataFrame], touched: list[int], before: Manifest | None, applied: dict[str, int], log) -> None:
        """Write the rows of all parts, one after the other, and name them in a new manifest."""
        version, schema = (before.version + 1 if before else 0), parts[0].schema.json()
        data = f"{self.path}/data/v={version}"
        for n, rows in enumerate(parts):
            out = rows.withColumn(BUCKET, self.bucket()).write.mode("append" if n else "overwrite").partitionBy(BUCKET)
            out.option("maxRecordsPerFile", self.rows_per_file).option("compression", PACKING).parquet(data)
        offsets = before.offsets if before else None
        if log is not None:
            seen = last_offsets(log, self.offsets(before) if before else None)
            seen.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/offsets/v={version}")
            offsets = version
        written = {
            int(n.split("=")[1]) for n in folders.children(self.spark, data) if n.startswith(f"{BUCKET}=")
        }
        kept = {b: v for b, v in (before.buckets if before else {}).items() if b not in touched}
        done = {**(before.applied if before else {}), **applied}
        self._write_manifest(
            Manifest(version, schema, {**kept, **{b: (version, schema) for b in written}}, done, self.buckets,
                     list(self.keys), offsets)
        )

    def _write_manifest(self, m: Manifest) -> None:
        out = self.spark.range(1, numPartitions=1).select(F.lit(m.text()).alias("value"))
        out.write.mode("overwrite").text(f"{self.path}/manifest/v={m.version}")

    def expire(self) -> None:
        """Remove the files no reader of the current manifest needs."""
        m = self.manifest()
        if m is None:
            return
        used = {"data": {f"v={v}" for v, _ in m.buckets.values()}, "offsets": {f"v={m.offsets}"},
                "manifest": {f"v={m.version}"}}
        for folder, keep in used.items():
            for name in folders.children(self.spark, f"{self.path}/{folder}"):
                if name not in keep:
                    folders.remove(self.spark, f"{self.path}/{folder}/{name}")

    def register(self, view: str) -> DataFrame:
        """The current rows as a temporary view."""
        df = self.read()
        df.createOrReplaceTempView(view)
        return df

