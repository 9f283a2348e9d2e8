"""Questions that batches of documents ask about their keys, and answers aligned to them.

Corpus-wide facts about very many keys (n-grams, anchors, spans) are not joined to
documents row by row.  Documents are packed once into batches of some MB, in a
table bucketed by batch.  A batch sends each of its distinct keys once, as sorted
and compressed arrays, to the bucket that owns the key's range; the bucket answers
with an array in the same order, which needs no keys.  So a key that a third of all
documents hold costs one entry per batch, a bucket is a bounded range of hashed
keys, and texts are never shuffled.  Every table lies in the shared folder, so
that a lost executor costs the tasks it ran only.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidefold.sinks.folders import shared_folder

BATCH_BYTES = 6 << 20
# raw text for which one bucket of keys is made: a million keys or two at most
BUCKET_BYTES = 4 << 20
ASKED = "bucket int, batch long, blob binary"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# -- arrays as bytes --------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed text of bytes; those of uint64 must be sorted and are kept as differences.

    Bytes lie in planes; of whole numbers from 0 on only as many as the largest one has.
    """
    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        kind = a.dtype.str.encode()
        if a.dtype == np.uint64 and len(a):
            a = np.diff(a, prepend=np.uint64(0))
        wide = a.dtype.itemsize
        if a.dtype.kind in "iu" and wide > 1 and len(a) and a.min() >= 0:
            wide = max(1, (int(a.max()).bit_length() + 7) // 8)
        head.append(struct.pack("<B", len(kind)) + kind + struct.pack("<qB", len(a), wide))
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize)
        # copied in place first: tobytes takes ten times as long over planes that are not
        body.append((a.astype(np.uint8) if wide == 1 and a.dtype.kind in "iu" else np.ascontiguousarray(planes[:, :wide].T)).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, kinds, out = raw[0], 1, [], []
    for _ in range(n):
        k = raw[at]
        kinds.append((np.dtype(raw[at + 1 : at + 1 + k].decode()), *struct.unpack_from("<qB", raw, at + 1 + k)))
        at += 10 + k
    for kind, size, wide in kinds:
        planes = np.frombuffer(raw, np.uint8, size * wide, at).reshape(wide, size)
        if wide == 1 and kind.kind in "iu":
            a = planes[0].astype(kind)
        else:
            a = np.zeros((size, kind.itemsize), np.uint8)
            for i in range(wide):
                a[:, i] = planes[i]
            a = a.view(kind).ravel()
        out.append(np.cumsum(a, dtype=np.uint64) if kind == np.uint64 else a)
        at += size * wide
    return out


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and where each given key is among them."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = _order(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inverse = np.empty(len(s), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return s[new], inverse


def _order(keys: np.ndarray) -> np.ndarray:
    """argsort; of hashes by their upper bits and places together, which sort faster, unless those are not enough."""
    bits = np.uint64(len(keys).bit_length())
    if keys.dtype != np.uint64 or bits > 24:
        return np.argsort(keys)
    place = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((keys & ~place) | np.arange(len(keys), dtype=np.uint64)) & place).astype(np.int64)
    s = keys[order]
    return order if (s[1:] >= s[:-1]).all() else np.argsort(keys)


# -- batches ----------------------------------------------------------------------


def _packed(limit: int, prepare: Callable[[pa.Table], pa.Table] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, rows, size, base = 0, [], 0, TaskContext.get().partitionId() << 31

        def emit():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(rows).combine_chunks()
            table = prepare(table) if prepare else table
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            return pa.RecordBatch.from_pydict(
                {"batch": pa.array([base + seq], pa.int64()), "raw": pa.array([size], pa.int64()),
                 "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
            )

        for part in parts:
            at = 0
            size_of = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False)
            each = np.concatenate([[0], np.cumsum(size_of.astype(np.int64) + 12)])
            while at < part.num_rows:
                # as many rows as fit, one at least
                upto = int(np.searchsorted(each, each[at] + max(limit - size, 0), "right")) - 1
                upto = min(max(upto, at + (not rows)), part.num_rows)
                if upto > at:
                    rows.append(part.slice(at, upto - at))
                    size += int(each[upto] - each[at])
                    at = upto
                if at < part.num_rows or size >= limit:
                    yield emit()
                    seq, rows, size = seq + 1, [], 0
        if rows:
            yield emit()

    return run


@dataclass(frozen=True)
class Batches:
    """Documents in batches of whole texts."""

    df: DataFrame
    spark: SparkSession
    parts: int
    buckets: int

    @staticmethod
    def write(
        docs: DataFrame, name: str, batch_bytes: int = BATCH_BYTES, prepare: Callable[[pa.Table], pa.Table] | None = None,
    ) -> "Batches":
        """Pack the given columns, `text` among them, once, into a table bucketed by batch.

        With `prepare` a batch holds what that makes of its documents, in place of them.
        """
        spark = docs.sparkSession
        docs = docs.withColumn("text", F.col("text").cast("string"))
        made = docs.mapInArrow(_packed(batch_bytes, prepare), "batch long, raw long, payload binary")
        parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        folder = shared_folder(spark, name)
        table = _table(folder)
        (made.write.option("path", folder).option("compression", "uncompressed")
         .bucketBy(parts, "batch").format("parquet").saveAsTable(table))
        df = spark.table(table)
        raw = df.agg(F.sum("raw")).first()[0] or 0
        return Batches(df, spark, parts, max(1, math.ceil(raw / BUCKET_BYTES)))

    def each(
        self, run: Callable[[int, pa.Table, dict], dict[str, list]], schema: str, *answers: DataFrame, own: tuple[DataFrame, ...] = (),
    ) -> DataFrame:
        """`run(batch, documents, answers)` for every batch, with the arrays of its answers by bucket.

        Of the tables `own` a batch finds its rows, or None, in a list at -1; they lie beside the documents and are not shuffled.
        """
        kinds, beside = len(answers), len(own)

        def one(batch: int, payload, got: dict) -> dict:
            docs = pa.ipc.open_stream(pa.py_buffer(payload)).read_all()
            return run(batch, docs, got)

        if not kinds:
            def plain(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for part in parts:
                    for i in range(part.num_rows):
                        yield from _frames(one(part["batch"][i].as_py(), part["payload"][i].as_buffer(), {}), schema)

            return self.df.select("batch", "payload").mapInArrow(plain, schema)

        both = None
        for k, df in enumerate(answers):
            df = df.select("batch", F.lit(k).alias("kind"), "bucket", "blob")
            both = df if both is None else both.unionByName(df)

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table(_frame({}, schema))
            got: dict = {k: {} for k in range(kinds)}
            got[-1] = [left[f"own{i}"][0].as_py() for i in range(beside)]
            for k, bucket, blob in zip(*(right[c].to_pylist() for c in ("kind", "bucket", "blob"))):
                got[k][bucket] = blob
            return pa.Table.from_batches(
                _frames(one(left["batch"][0].as_py(), left["payload"].chunk(0)[0].as_buffer(), got), schema)
            )

        asked = both.repartition(self.parts, "batch").groupBy("batch")
        mine = self.df.select("batch", "payload")
        for i, rows in enumerate(own):
            mine = mine.join(rows.select("batch", F.col("blob").alias(f"own{i}")).hint("merge"), "batch", "left")
        return mine.groupBy("batch").cogroup(asked).applyInArrow(meet, schema)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The rows as a table in the shared folder, computed once."""
        return self.spark.read.schema(df.schema).parquet(self.stored(df, name))

    def stored(self, df: DataFrame, name: str) -> str:
        """The shared folder of the rows, computed once."""
        folder = shared_folder(self.spark, name)
        with _no_shuffle_left(self.spark):
            df.write.option("compression", "uncompressed").parquet(folder)
        return folder

    def asked(self, df: DataFrame, name: str) -> tuple[str, str]:
        """Folders of the batches' own rows (bucket -1), one a batch at most, and of their questions, computed once."""
        folder = shared_folder(self.spark, name)
        with _no_shuffle_left(self.spark):
            (df.withColumn("own", F.col("bucket") < 0).write.option("path", folder).option("compression", "uncompressed")
             .partitionBy("own").bucketBy(self.parts, "batch").format("parquet").saveAsTable(_table(folder)))
        return f"{folder}/own=true", f"{folder}/own=false"

    def own(self, folder: str) -> DataFrame:
        """The batches' own rows of such a folder, bucketed as the batches are."""
        return self.spark.table(_table(folder.rsplit("/", 1)[0])).where("own")

    def rows(self, folder: str) -> DataFrame:
        return self.spark.read.schema(ASKED).parquet(folder)


def _table(folder: str) -> str:
    return "b" + folder.rsplit("-", 1)[1]


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def _arrow_type(name: str) -> pa.DataType:
    plain = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary()}
    return pa.list_(plain[name[6:-1]]) if name.startswith("array<") else plain[name]


def _frame(columns: dict, schema: str) -> dict:
    kinds = [c.split() for c in schema.split(", ")]
    made = {n: columns.get(n, []) for n, _ in kinds}
    return {n: made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], _arrow_type(t)) for n, t in kinds}


def _frames(columns: dict, schema: str) -> list[pa.RecordBatch]:
    return [pa.RecordBatch.from_pydict(_frame(columns, schema))]


# -- questions and answers ----------------------------------------------------------


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of hashed keys begins in sorted keys, with the end at last."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def question(
    batch: int, buckets: int, keys: np.ndarray, *more: np.ndarray, some: tuple[np.ndarray, tuple[np.ndarray, ...]] | None = None,
) -> dict[str, list]:
    """Rows that send sorted distinct keys, and arrays beside them, to the buckets they belong to.

    `some` tells which keys further arrays are of, that have nothing for the others.
    """
    at = bounds(keys, buckets)
    full = [b for b in range(buckets) if at[b + 1] > at[b]]
    which, rest = some or (np.zeros(len(keys), bool), ())
    to = np.concatenate([[0], np.cumsum(which)])[at]
    blobs = [pack(keys[at[b] : at[b + 1]], *[m[at[b] : at[b + 1]] for m in more], *[m[to[b] : to[b + 1]] for m in rest]) for b in full]
    return {"bucket": full, "batch": [batch] * len(full), "blob": blobs}


def answer(asked: DataFrame, run: Callable[[list[list[np.ndarray]]], list[tuple]]) -> DataFrame:
    """`run(questions)` for every bucket: one tuple of arrays per question, in the order of its keys.

    The questions come in the order of their batches.
    """

    def bucket(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("batch")
        asks = [unpack(b) for b in rows["blob"].to_pylist()]
        blobs = [pack(*a) for a in run(asks)]
        return pa.table({"bucket": rows["bucket"], "batch": rows["batch"], "blob": pa.array(blobs, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(bucket, ASKED)


def ids_of(docs: pa.Table, name: str = "doc_id") -> tuple[np.ndarray, pa.Array]:
    """Ids as numbers, null before all others, and as they are."""
    column = docs[name].combine_chunks().cast(pa.int64())
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return pc.fill_null(column, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), column


def joined(got: dict[int, bytes], place: int = 0, kind: str = "i8") -> np.ndarray:
    """A batch's answers of all buckets, in the order of its sorted keys."""
    parts = [unpack(got[b])[place] for b in sorted(got)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def summed(asks: list[list[np.ndarray]]) -> list[tuple]:
    """The sum over all batches of the second array, for each key."""
    sizes = [len(a[0]) for a in asks]
    _, inverse = unique(np.concatenate([a[0] for a in asks]))
    value = np.concatenate([a[1] for a in asks])
    total = np.bincount(inverse, weights=value.astype(np.float64))
    if value.dtype.kind != "f":
        total = total.astype(np.int64)
    return [(part,) for part in np.split(total[inverse], np.cumsum(sizes)[:-1])]
