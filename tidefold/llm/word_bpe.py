"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding
--------
1. Texts are cut into pre-tokens, the matches of the tokenizer's pattern, on the bytes of whole
   slices of some megabytes.  A slice becomes some rows of a table bucketed by slice: its documents, the
   number of pre-tokens of each, for every position the number of its word within the slice,
   frequent words first, and the words.
2. The words of all slices are exploded to (slice, number, word) and shuffled by word.  Each distinct
   word of the corpus is thereby in one partition, sorted, and is encoded once.  No word is asked for
   more than once by a slice, so that the most frequent has as many rows as there are slices.
3. The ids are joined back to their slice, those of many words in a row.
4. Each slice puts the ids at the places of its words, in the order of their positions.

Only distinct words of a slice are shuffled, neither texts nor positions.

Decoding joins every id with the table of token bytes.  The table is the vocabulary, whose size
the file bounds; it is read as a DataFrame and its bytes lie in one broadcast array, in which
tasks look all ids of a batch up at once.

The pattern
-----------
`cut` does what `public_tokenizers.PATTERN` says: contractions, runs of letters, of numbers and of
other marks, each with one space before it, and runs of white space.  The classes of characters
are asked of tiktoken itself, since libraries know different versions of Unicode.

Cases: a null or empty text has no ids and decodes to no bytes; texts and words may be of any
length; rows that repeat an id are rows each; null ids stay null; an empty table gives no rows;
other columns are ignored.  Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidefold.llm.textbytes import buffer_of, hash_spans, ragged, slices
from tidefold.sinks.folders import shared_folder

SLICE = 32 << 20  # bytes of text in a slice, but for longer texts
PART = 1 << 20  # bytes that are cut at once, but for longer texts
ANSWERS = 1 << 18  # words whose ids a task sorts by slice at once
CHUNK = 1 << 19  # positions in a row of a slice, but for longer texts; an eighth as many words

# fixed values: the contractions of the pattern, in its order
CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")
OTHER, LETTER, NUMBER, SPACE = range(4)


# -- pre-tokens ---------------------------------------------------------------------


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, as the regular expressions of tiktoken have it."""
    import tiktoken

    out = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        single = tiktoken.Encoding(pattern, pat_str=pattern, special_tokens={}, mergeable_ranks={bytes([i]): i for i in range(256)})
        for a in range(0, 0x110000, 0x4000):
            if 0xD800 <= a < 0xE000:
                continue
            some = "".join(map(chr, range(a, min(a + 0x4000, 0xD800 if a < 0xD800 else 0x110000))))
            found = bytes(single.encode_ordinary(some)).decode()
            out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


def _code_points(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters whose first bytes are at `first`."""
    lead = data[first].astype(np.int64)
    point = lead.copy()
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        size = 2 + (lead[wide] >= 0xE0) + (lead[wide] >= 0xF0)
        value = lead[wide] & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            at = wide[more]
            value[more] = (value[more] << 6) | (data[first[at] + k] & 0x3F)
        point[wide] = value
    return point


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of all texts start, and the first one of each text with their number at last."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    char = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    kind = classes()[_code_points(data, char)]
    plain = data[char] == 0x20
    text = np.zeros(n + 1, bool)
    text[at] = True
    fresh = text[char]  # the first character of a text
    run = fresh.copy()  # the first character of a run of one class
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    start = run.copy()
    # the last of several white spaces before another character is a pre-token's own: it may be its leading space
    last = space.copy()
    last[:-1] &= (kind[1:] != SPACE) & ~fresh[1:]
    last[-1] = False
    start |= last
    # a single space belongs to the run after it
    joined = np.zeros(len(char), bool)
    joined[1:] = last[:-1] & plain[:-1]
    start &= ~(joined & run)
    # contractions: an apostrophe that begins a run of marks and a pre-token, and stands alone before letters
    tick = np.flatnonzero((data[char] == 0x27) & run & start)
    tick = tick[tick + 1 < len(char)]
    if len(tick):
        tail = np.concatenate([data, np.zeros(3, np.uint8)])
        b = char[tick]
        same = np.zeros(len(tick), np.int64)
        for word in CONTRACTIONS:
            hit = same == 0
            for k in range(1, len(word)):
                hit &= (tail[b + k] == word[k]) & ~text[np.minimum(b + k, n)]
            same[hit] = len(word)
        tick, same = tick[same > 0], same[same > 0]
        start[tick + 1] = False
        after = tick + same
        ok = after < len(char)
        after = after[ok]
        start[after] |= kind[after] == LETTER  # the rest of the letters; other runs start of themselves
    starts = char[start]
    return starts, np.searchsorted(starts, at)


# -- slices ---------------------------------------------------------------------------

SLICES = "slice long, chunk int, doc_ids array<long>, counts array<int>, places binary, first int, words array<binary>"


def _planes(values: np.ndarray) -> bytes:
    """32-bit integers as the lowest bytes of all, the next of all and so on: the empty ones vanish when compressed."""
    return np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Slice:
    """Documents and the words at their positions."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.doc_ids, self.counts, self.places, self.bytes = [], [], [], 0

    def add(self, rows: pa.RecordBatch) -> None:
        data, at = buffer_of(rows["text"])
        start, first = cut(data, at)
        end = np.append(start[1:], len(data))
        # words are equal where two hashes are, 128 bits together
        one, two = hash_spans(data, start, end), hash_spans(data, start, end, 1)
        order = np.argsort(one, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = one[order][1:] != one[order][:-1]
        if (~new[1:] & (two[order][1:] != two[order][:-1])).any():  # all but never
            order = np.lexsort((two, one))
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        raw, head = data.tobytes(), order[new]
        known = self.known
        number = [known.setdefault(raw[s:e], len(known)) for s, e in zip(start[head].tolist(), end[head].tolist())]
        place = np.empty(len(start), np.int32)
        place[order] = np.repeat(np.array(number, np.int32), np.diff(np.append(np.flatnonzero(new), len(order))))
        self.doc_ids.append(rows["doc_id"]), self.counts.append(np.diff(first)), self.places.append(place)
        self.bytes += len(data) + 64 * rows.num_rows

    def rows(self, number: int, size: int) -> Iterator[pa.RecordBatch]:
        places, counts, doc_ids = np.concatenate(self.places), np.concatenate(self.counts), pa.concat_arrays(self.doc_ids)
        count = np.bincount(places, minlength=len(self.known)).tolist()
        # frequent words first, words of one count in order: both compress well
        often = sorted(self.known.items(), key=lambda w: (-count[w[1]], w[0]))
        rank = np.empty(len(often), np.int32)
        rank[[i for _, i in often]] = np.arange(len(often), dtype=np.int32)
        words, places, upto = [w for w, _ in often], rank[places], np.concatenate([[0], np.cumsum(counts)])
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
        chunk, d, w = 0, 0, 0
        while d < len(counts) or w < len(words):
            z = min(max(d + 1, int(np.searchsorted(upto, upto[d] + size, "right")) - 1), len(counts))
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([number], pa.int64()), "chunk": pa.array([chunk], pa.int32()),
                "doc_ids": one(doc_ids.slice(d, z - d), pa.int64()), "counts": one(counts[d:z].astype(np.int32), pa.int32()),
                "places": pa.array([_planes(places[upto[d] : upto[z]])], pa.binary()),
                "first": pa.array([w], pa.int32()), "words": one(words[w : w + max(1, size // 8)], pa.binary())})
            chunk, d, w = chunk + 1, z, w + max(1, size // 8)


def _sliced(limit: int, chunk: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Slice()
        for part in parts:
            for rows in slices(part, min(limit, PART)):
                held.add(rows)
                if held.bytes >= limit:
                    yield from held.rows(number, chunk)
                    number, held = number + 1, Slice()
        if held.doc_ids:
            yield from held.rows(number, chunk)

    return run


# -- encoding -------------------------------------------------------------------------


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoded(ranks_path: str, pattern: str, most: int):
    """Rows sorted by word get the ids of their words, each word encoded where it begins; rows of many words of a slice."""

    def packed(slice_: np.ndarray, number: np.ndarray, size: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(slice_, kind="stable")
        first = np.cumsum(size) - size
        head = np.flatnonzero(np.diff(slice_[order], prepend=slice_[order][0] - 1))
        ends = np.append(head, len(order))
        words, at = size[order], np.concatenate([[0], np.cumsum(size[order])])
        number, ids = number[order], ids[ragged(first[order], words)]
        blobs = lambda values, cuts: pa.array([_planes(values[a:z]) for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())
        return pa.RecordBatch.from_pydict({
            "slice": pa.array(slice_[order][head]), "numbers": blobs(number, ends), "sizes": blobs(words, ends), "ids": blobs(ids, at[ends])})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks_path, pattern).encode_ordinary
        word, ids, held, n = None, [], [], 0
        for part in parts:
            flat, size = [], []
            for w in part["word"].to_pylist():
                if w != word:
                    word, ids = w, encode(w.decode())
                flat.extend(ids)
                size.append(len(ids))
            held.append((part["slice"].to_numpy(), part["number"].to_numpy(), np.array(size), np.array(flat, np.int32)))
            n += len(size)
            if n >= most:
                yield packed(*(np.concatenate(c) for c in zip(*held)))
                held, n = [], 0
        if n:
            yield packed(*(np.concatenate(c) for c in zip(*held)))

    return run


ENCODED = "slice long, numbers binary, sizes binary, ids binary"


def _assembled(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """One slice: the ids of each document, from its places and the ids of its words."""
    joined = lambda table, c: np.concatenate([_from_planes(v.as_buffer()) for v in table[c]] or [np.zeros(0, np.int32)])
    numbers, sizes, ids = (joined(right, c) for c in ("numbers", "sizes", "ids"))
    size, first = np.zeros(len(numbers), np.int32), np.zeros(len(numbers), np.int64)
    size[numbers], first[numbers] = sizes, np.cumsum(sizes) - sizes
    del numbers, sizes
    out = []
    for i in np.argsort(left["chunk"].to_numpy()).tolist():  # the places of one row of the slice at a time
        docs, counts = left["doc_ids"][i].values, left["counts"][i].values.to_numpy().astype(np.int64)
        places, upto = _from_planes(left["places"][i].as_buffer()), np.concatenate([[0], np.cumsum(counts)])
        d = 0
        while d < len(docs):  # some documents at a time
            z = max(d + 1, int(np.searchsorted(upto, upto[d] + (1 << 18), "right")) - 1)
            p = places[upto[d] : upto[z]]
            n = size[p]
            at = np.concatenate([[0], np.cumsum(n)])[upto[d : z + 1] - upto[d]]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids[ragged(first[p], n)]))
            out.append(pa.RecordBatch.from_arrays([docs.slice(d, z - d), lists], ["doc_id", "ids"]))
            d = z
    return pa.Table.from_batches(out)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row; `ranks_path` is a file every executor can open."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "bpe")
    table = "w" + folder.rsplit("-", 1)[1]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sliced(SLICE, CHUNK), SLICES)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.option("path", folder).option("compression", "zstd").bucketBy(parts, "slice").format("parquet").saveAsTable(table)
    asked = spark.table(table).select("slice", "first", F.posexplode("words").alias("place", "word"))
    asked = asked.select("slice", (F.col("first") + F.col("place")).alias("number"), "word")
    asked = asked.repartition("word").sortWithinPartitions("word")
    answers = asked.mapInArrow(_encoded(ranks_path, pattern, ANSWERS), ENCODED)
    stored = spark.table(table).select("slice", "chunk", "doc_ids", "counts", "places")
    return stored.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_assembled, "doc_id long, ids array<int>")


# -- decoding -------------------------------------------------------------------------


def token_bytes(spark: SparkSession, ranks_path: str) -> DataFrame:
    """(id, bytes) of every token of a vocabulary file."""
    with open(ranks_path, "rb") as f:
        rows = [(int(b), base64.b64decode(a)) for a, b in map(bytes.split, f)]
    return spark.createDataFrame(rows, "id int, bytes binary")


def decode(encoded: DataFrame, tokens: DataFrame, packed: bool = False) -> DataFrame:
    """All columns of `encoded` and `decoded`: the bytes of its `ids`, joined with `tokens` (id, bytes).

    With `packed` also the ids as little-endian unsigned 32-bit integers.  An id that is not in the table is an error.
    """
    table = tokens.orderBy("id").collect()  # the vocabulary
    size = np.full(max((r.id for r in table), default=-1) + 1, -1, np.int64)
    size[[r.id for r in table]] = [len(r.bytes) for r in table]
    shared = encoded.sparkSession.sparkContext.broadcast((size, b"".join(bytes(r.bytes) for r in table)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, raw = shared.value
        flat, first = np.frombuffer(raw, np.uint8), np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
        for whole in parts:
            at = whole["ids"].offsets.to_numpy().astype(np.int64)
            r = 0
            while r < whole.num_rows:  # some rows at a time
                z = max(r + 1, int(np.searchsorted(at, at[r] + (1 << 18), "right")) - 1)
                part, done, plain = whole.slice(r, z - r), [], []
                for a, b in zip(at[r:z].tolist(), at[r + 1 : z + 1].tolist()):
                    ids = whole["ids"].values[a:b].to_numpy()
                    if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or (size[ids] < 0).any()):
                        raise ValueError("an id is not in the table of tokens")
                    done.append(flat[ragged(first[ids], size[ids])].tobytes())
                    plain.append(ids.astype("<u4").tobytes() if packed else None)
                columns = [*part.columns, pa.array(done, pa.binary()), *([pa.array(plain, pa.binary())] if packed else [])]
                yield pa.RecordBatch.from_arrays(columns, names)
                r = z

    names = [*encoded.columns, "decoded", *(["packed"] if packed else [])]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema), *(f"{n} binary" for n in names[len(encoded.columns):])])
    return encoded.mapInArrow(run, schema)
