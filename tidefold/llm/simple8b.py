"""Token ids in binary files of Simple-8b words.

The format
----------
A file set is a Parquet folder of blocks: (shard, block, n_docs, n_ids, payload), shards and
blocks in ascending document order, each block some whole documents.  A payload is

    magic "S8B1", then little-endian int64: documents, ids, words, escapes
    document ids (int64 each), null flags (uint8 each), lengths in ids (int64 each)
    offsets (uint32 each): the first word of every group of 128 ids, so that groups decode side by side
    words (uint64 each): selector in the top 4 bits, then up to 60 bits of values, the first lowest
    escapes (uint64 each): values of 2^60 and more; a word of selector 0 holds the index of one

`index` beside it holds the number of ids before every block.

Tokenising
----------
`tokenizers` encodes the texts, in pieces: a byte-level vocabulary whose pattern starts a new
word at a single space between two non-spaces gives the same ids for the pieces cut there,
and a piece that was seen before is not encoded again.  Where either neighbour may be a white
space character beyond ASCII no cut is made.

Cases: a null text is empty, and has the end id alone; rows of one doc_id follow each other in
the order of their texts; a null doc_id comes first; an empty table gives an empty file set;
other columns are ignored; texts and ids may be of any size.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidefold.llm.textbytes import SMALL_BYTES, buffer_of, freed, hash_spans, large, ragged, slices
from tidefold.sinks.folders import shared_folder

GROUP = 128
BLOCK_IDS = 1 << 20
MAGIC = b"S8B1"
# fixed values: how many values a word of each selector holds, and their bits
COUNT = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120])
WIDTH = np.array([60, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
BLOCKS = "shard int, block int, n_docs long, n_ids long, payload binary"


# -- Simple-8b ------------------------------------------------------------------------


def _bits(v: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    out = np.zeros(len(v), np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):
        big = (v >> np.uint64(shift)) > 0
        out += big.astype(np.uint8) * np.uint8(shift)
        v = np.where(big, v >> np.uint64(shift), v)
    return out + (v > 0).astype(np.uint8)


_SMALL = np.ceil(np.log2(np.arange(1 << 17) + 1)).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets of the groups, escapes) of values below 2^64."""
    values = values.astype(np.uint64)
    n = len(values)
    groups = -(-n // GROUP)
    need = _SMALL[values.astype(np.int64)] if n and values.max() < len(_SMALL) else _bits(values)
    # per group, with room for the widest look ahead; beyond a group's end all fits
    look = np.zeros((groups, GROUP + int(COUNT.max())), np.uint8)
    look[:, :GROUP].reshape(-1)[:n] = 0
    flat = np.zeros(groups * GROUP, np.uint8)
    flat[:n] = need
    look[:, :GROUP] = flat.reshape(groups, GROUP)
    selector = (look[:, :GROUP] <= WIDTH[1]).astype(np.uint8)  # 0: an escape
    most, wide = look, 1
    for s in range(2, 16):
        c = int(COUNT[s])
        while wide < c:
            step = min(wide, c - wide)
            most = np.maximum(most[:, :-step], most[:, step:])
            wide += step
        selector += (most[:, :GROUP] <= WIDTH[s]) & (selector == s - 1)
    length = np.full(groups, GROUP)
    if groups:
        length[-1] = n - GROUP * (groups - 1)
    # all groups take their next word at once
    row, at = np.arange(groups), np.zeros(groups, np.int64)
    rows, ats, picks, steps, step = [], [], [], [], 0
    while len(row):
        pick = selector[row, at]
        rows.append(row), ats.append(at), picks.append(pick), steps.append(np.full(len(row), step))
        at = at + COUNT[pick]
        more = at < length[row]
        row, at, step = row[more], at[more], step + 1
    if not groups:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    row, at, pick, step = (np.concatenate(x) for x in (rows, ats, picks, steps))
    used = np.bincount(row, minlength=groups)
    offset = np.cumsum(used) - used
    place = offset[row] + step
    tail = np.concatenate([values, np.zeros(COUNT.max(), np.uint64)])
    words, escapes = np.empty(len(row), np.uint64), np.zeros(0, np.uint64)
    for s in range(16):
        m = np.flatnonzero(pick == s)
        if not len(m):
            continue
        start = row[m] * GROUP + at[m]
        if s == 0:
            m = m[np.argsort(place[m])]
            escapes = tail[row[m] * GROUP + at[m]]
            words[place[m]] = np.arange(len(m), dtype=np.uint64)
            continue
        w = np.zeros(len(m), np.uint64)
        if WIDTH[s]:
            for k in range(int(COUNT[s])):
                v = np.where(at[m] + k < GROUP, tail[np.minimum(start + k, len(tail) - 1)], np.uint64(0))
                w |= v << np.uint64(k * int(WIDTH[s]))
        words[place[m]] = w | np.uint64(s) << np.uint64(60)
    return words, offset.astype(np.uint32), escapes


def decode(words: np.ndarray, offset: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values."""
    pick = (words >> np.uint64(60)).astype(np.int64)
    taken = np.cumsum(COUNT[pick]) - COUNT[pick]
    used = np.diff(np.append(offset.astype(np.int64), len(words)))
    inside = taken - np.repeat(taken[offset], used) if len(offset) else taken
    start = inside + GROUP * np.repeat(np.arange(len(offset)), used)
    out = np.zeros(len(offset) * GROUP, np.uint64)
    for s in range(15):  # the last selector holds zeros
        m = np.flatnonzero(pick == s)
        if not len(m):
            continue
        if s == 0:
            out[start[m]] = escapes[(words[m] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        low = np.uint64((1 << int(WIDTH[s])) - 1)
        for k in range(int(COUNT[s])):
            ok = m[inside[m] + k < GROUP]
            out[start[ok] + k] = (words[ok] >> np.uint64(k * int(WIDTH[s]))) & low
    return out[:n]


# -- payloads -------------------------------------------------------------------------


def to_payload(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offset, escapes = encode(ids)
    head = MAGIC + struct.pack("<4q", len(doc_ids), len(ids), len(words), len(escapes))
    parts = (doc_ids.astype("<i8"), nulls.astype("u1"), lengths.astype("<i8"), offset.astype("<u4"),
             words.astype("<u8"), escapes.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def from_payload(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, null flags, lengths, ids)."""
    if raw[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    docs, n, words, escapes = struct.unpack_from("<4q", raw, 4)
    at, out = 36, []
    for kind, size in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<u4", -(-n // GROUP)), ("<u8", words), ("<u8", escapes)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out[0], out[1].astype(bool), out[2], decode(out[4], out[3], out[5], n)


# -- tokenising -------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_WIDE = np.zeros(256, bool)  # first bytes of characters among which are white spaces
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
# pieces known to a worker at most (some 60 bytes each), and pieces encoded as one text
CACHED = 600_000
JOINED = 50


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the pieces of all texts, and the first piece of each text with their number at last."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        bare = _SPACE[data]
        after = _WIDE[data]
        unsafe = bare.copy()  # whether the character that ends here may be a white space
        unsafe[1:] |= data[:-1] == 0xC2
        unsafe[2:] |= after[:-2] & (data[:-2] != 0xC2)
        cut[1:-2] = (data[1:-1] == 0x20) & ~unsafe[:-2] & ~bare[2:] & ~after[2:]
    cut[at] = True
    cut[n] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    return start, end, np.searchsorted(start, at)


class Encoder:
    """Encodes texts by one tokenizer file, each distinct piece once; pieces seen repeatedly stay known."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # a byte-level token has one character per byte
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self._set(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _set(self, keys: np.ndarray, check: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Known pieces: sorted hashes, the entry of each, and the entries."""
        self.entry = np.argsort(keys)
        self.keys, self.check, self.size, self.flat = keys[self.entry], check, size, flat
        self.first, self.uses = np.cumsum(size) - size, np.zeros(len(size), np.uint8)

    def _forget(self) -> None:
        """Keep the pieces that were met more than once."""
        often = np.flatnonzero(self.uses > 1)
        often = often if len(often) <= CACHED // 2 else often[:0]
        keys = np.empty(len(self.keys), np.uint64)
        keys[self.entry] = self.keys
        size = self.size[often]
        self._set(keys[often], self.check[often], size, self.flat[ragged(self.first[often], size)])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for g in got for i in g), np.uint32, int(size.sum())), size

    def _encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, inner: np.ndarray):
        """Ids of pieces, and their number per piece.

        Pieces from within texts begin and end where the pattern begins a word, so that many are
        encoded as one text; the bytes of the ids tell where each ends.
        """
        size = np.zeros(len(start), np.int64)
        parts, order = [], []
        raw = data.tobytes()
        inside, others = np.flatnonzero(inner), np.flatnonzero(~inner)
        if len(inside):
            length = end[inside] - start[inside]
            groups = range(0, len(inside), JOINED)
            a, z = start[inside].tolist(), end[inside].tolist()
            texts = [b"".join([raw[a[k]:z[k]] for k in range(g, min(g + JOINED, len(a)))]).decode() for g in groups]
            ids, _ = self._encode(texts)
            bytes_, ends = np.cumsum(self.bytes[ids]), np.cumsum(length)
            upto = np.searchsorted(bytes_, ends)
            if len(bytes_) and bytes_[-1] == ends[-1] and np.array_equal(bytes_[upto], ends):
                size[inside] = np.diff(upto + 1, prepend=0)
                parts.append(ids), order.append(inside)
            else:
                others = np.arange(len(start))
        if len(others):
            ids, n = self._encode([raw[x:y].decode() for x, y in zip(start[others].tolist(), end[others].tolist())])
            size[others] = n
            parts.append(ids), order.append(others)
        order = np.concatenate(order)
        flat = np.concatenate(parts)
        at = np.empty(len(start), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        return flat[ragged(at, size)], size

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text)."""
        start, end, first = pieces(data, at)
        key, other = hash_spans(data, start, end), hash_spans(data, start, end, 1)
        distinct, one, of = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > CACHED:
            self._forget()
        where = np.searchsorted(self.keys, distinct)
        known = where < len(self.keys)
        known[known] = self.keys[where[known]] == distinct[known]
        entry = np.empty(len(distinct), np.int64)
        entry[known] = self.entry[where[known]]
        new = np.flatnonzero(~known)
        if len(new):
            m = one[new]
            edge = np.zeros(len(start), bool)
            full = first[1:] > first[:-1]
            edge[first[:-1][full]] = edge[first[1:][full] - 1] = True
            ids, size = self._encode_pieces(data, start[m], end[m], ~edge[m])
            entry[new] = len(self.size) + np.arange(len(new))
            self.first = np.append(self.first, len(self.flat) + np.cumsum(size) - size)
            self.size, self.flat = np.append(self.size, size), np.append(self.flat, ids)
            self.check, self.uses = np.append(self.check, other[m]), np.append(self.uses, np.zeros(len(new), np.uint8))
            self.keys = np.insert(self.keys, where[new], distinct[new])
            self.entry = np.insert(self.entry, where[new], entry[new])
        self.uses[entry] = np.minimum(self.uses[entry], 1) + 1
        place = entry[of]
        if not np.array_equal(self.check[place], other):  # two pieces of one hash
            raw = data.tobytes()
            return self._encode([raw[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
        size = self.size[place]
        total = np.concatenate([[0], np.cumsum(size)])[first]
        return self.flat[ragged(self.first[place], size)], np.diff(total)


@large
@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, whatever the number of its tasks."""
    return Encoder(path)


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
    return out, lengths + 1


def _encoded(path: str, end_id: int, block_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, shard, block, waiting, n = encoder(path), TaskContext.get().partitionId(), 0, [], 0

        def emit():
            docs, nulls, lengths, ids = (np.concatenate(x) for x in zip(*waiting))
            row = {"shard": shard, "block": block, "n_docs": len(docs), "n_ids": len(ids),
                   "payload": to_payload(docs, nulls, lengths, ids)}
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_pydict({c: pa.array([v], t) for (c, v), t in zip(row.items(), kinds)})

        for part in parts:
            for rows in slices(part, SMALL_BYTES):
                ids, lengths = _with_end(*encode_texts(*buffer_of(rows["text"])), end_id)
                column = rows["doc_id"].cast(pa.int64())
                waiting.append((column.fill_null(0).to_numpy(zero_copy_only=False),
                                column.is_null().to_numpy(zero_copy_only=False), lengths, ids))
                n += len(ids)
                if n >= block_ids:
                    yield emit()
                    block, waiting, n = block + 1, [], 0
        if waiting:
            yield emit()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode whole texts, `end_id` after each, into a file set in ascending doc_id order.

    `tokenizer` is a path every executor can open.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # a tie of many rows is spread by a hash; rows of one id follow each other in the order of that hash and the text
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    blocks = rows.mapInArrow(freed(_encoded(tokenizer, end_id, block_ids), keep=True), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("shard", "block", "n_ids")
    before = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    # one row per shard
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("all"))
    shards = shards.select("shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("base"))
    index = stored.withColumn("before", before).join(shards, "shard")
    index.select("shard", "block", (F.col("base") + F.col("before")).alias("first")).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and the ids."""
    schema = "shard int, block int, nth long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    if with_ids:
        schema += ", ids array<int>"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                docs, nulls, lengths, ids = from_payload(part["payload"][i].as_py())
                at = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                n = len(docs)
                out = {"shard": pa.array(np.full(n, part["shard"][i].as_py()), pa.int32()),
                       "block": pa.array(np.full(n, part["block"][i].as_py()), pa.int32()),
                       "nth": pa.array(np.arange(n)), "doc_id": pa.array(docs, pa.int64(), mask=nulls),
                       "inside": pa.array(at[:-1]), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("shard", "block", "payload")
    index = spark.read.schema("shard int, block int, first long").parquet(f"{folder}/index")
    df = blocks.mapInArrow(freed(run), schema).join(index, ["shard", "block"])
    return df.withColumn("start", F.col("first") + F.col("inside")).drop("first", "inside")


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-ids")
