"""Words of documents that lie in passages of benchmark items, by a prefix-filtered set join.

Texts are lower-cased (A-Z) and cut into words of letters and digits.  A window is `window`
consecutive words of an item; an item of fewer words, but not none, is one window.  As a set
join: the tokens of a window are its shingles of three words (or of all its words where it has
fewer), ordered by how rare they are in all documents.  A document contains a window only if
it contains every token, so a prefix of one token, the rarest, is all that must be joined.
A join partner at token place p proposes the window to start at p minus the token's place in
the window; it must lie within the document (positional and length bound), and is verified word
for word.  Words inside a verified window are hit.

Items are taken in blocks of at most `block_bytes` of text, so that what is broadcast is bounded
for any benchmark; every block is joined with all documents.

Cases: null texts have no words; a null item_id is written as an empty text; items that share
an id are one item; ties of rarity go to the earlier token; repeated documents are judged each;
empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidefold.llm.choose import without
from tidefold.llm.textbytes import ALNUM, C1, LOWER, buffer_of, freed, hash_spans, mix, ragged, slices, word_spans
from tidefold.sinks.folders import shared_folder

WINDOW = 10
TOKEN_WORDS = 3
BLOCK_BYTES = 32 << 20
HITS = "doc_id long, text string, n_words long, starts array<long>, ends array<long>, items array<string>"


class Words:
    """The words of texts in a row: hashes, and the first word of each text with their number at last."""

    def __init__(self, column):
        self.data, at = buffer_of(column)
        self.data = LOWER[self.data]
        self.start, self.end, self.first = word_spans(self.data, at, ALNUM)
        self.hash = hash_spans(self.data, self.start, self.end)

    def tokens(self, n: int) -> np.ndarray:
        """For every word the hash of the n words from it on, those beyond the last text's end included."""
        tail = np.concatenate([self.hash, np.zeros(n, np.uint64)])
        out = np.full(len(self.hash), n, np.uint64)
        for k in range(n):
            out = mix(out * C1 + tail[k : k + len(out)])
        return out

    def check(self, which: np.ndarray) -> np.ndarray:
        """A second hash of the given words."""
        return hash_spans(self.data, self.start[which], self.end[which], 1)


@dataclass
class Windows:
    """Distinct windows of a block of items."""

    first: np.ndarray  # of each window among `words`
    size: np.ndarray
    words: np.ndarray
    checks: np.ndarray
    items: list[list[str]]  # by window
    tokens: dict[int, np.ndarray]  # by words per token: sorted distinct hashes

    @staticmethod
    def of(ids: list[str], texts: list[str | None], window: int) -> "Windows":
        w = Words(pa.array(texts, pa.string()))
        checks = w.check(np.arange(len(w.hash)))
        seen: dict[tuple, int] = {}
        first, size, items = [], [], []
        for i, (a, z) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            n = min(window, z - a)
            for s in range(a, z - n + 1) if n else ():
                k = (w.hash[s : s + n].tobytes(), checks[s : s + n].tobytes())
                if k not in seen:
                    seen[k] = len(first)
                    first.append(s), size.append(n), items.append([])
                if ids[i] not in items[seen[k]]:
                    items[seen[k]].append(ids[i])
        out = Windows(np.array(first, np.int64), np.array(size, np.int64), w.hash, checks, items, {})
        for m in sorted({min(TOKEN_WORDS, s) for s in size}):
            mine = np.minimum(out.size, TOKEN_WORDS) == m
            places = ragged(out.first[mine], out.size[mine] - m + 1)
            out.tokens[m] = np.unique(w.tokens(m)[places])
        out.all_tokens = {m: w.tokens(m) for m in out.tokens}
        return out

    def prefixes(self, counts: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per words per token: (rarest token, its place in the window, window), sorted by token."""
        out = {}
        for m, known in self.tokens.items():
            which = np.flatnonzero(np.minimum(self.size, TOKEN_WORDS) == m)
            token, place = [], []
            for i in which.tolist():
                t = self.all_tokens[m][self.first[i] : self.first[i] + self.size[i] - m + 1]
                p = int(np.argmin(counts[m][np.searchsorted(known, t)]))
                token.append(t[p]), place.append(p)
            order = np.argsort(np.array(token, np.uint64), kind="stable")
            out[m] = (np.array(token, np.uint64)[order], np.array(place, np.int64)[order], which[order])
        return out


class Lookup:
    """Which of many hashes are among sorted ones: a table of their low bits decides most."""

    def __init__(self, known: np.ndarray):
        bits = max(16, int(len(known)).bit_length() + 5)
        self.known, self.low = known, np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[(known & self.low).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of hashes that are known, where their first equal stands among the known)."""
        maybe = np.flatnonzero(self.table[(hashes & self.low).astype(np.int64)])
        at = np.searchsorted(self.known, hashes[maybe])
        ok = at < len(self.known)
        ok[ok] = self.known[at[ok]] == hashes[maybe[ok]]
        return maybe[ok], at[ok]


def _counts(docs: DataFrame, windows: Windows) -> dict[int, np.ndarray]:
    """How often each token of the block's windows occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(windows.tokens)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {m: Lookup(known) for m, known in shared.value.items()}
        total = {m: np.zeros(len(known), np.int64) for m, known in shared.value.items()}
        for part in (s for p in parts for s in slices(p)):
            w = Words(part["text"])
            for m, lookup in lookups.items():
                _, at = lookup(w.tokens(m))
                total[m] += np.bincount(at, minlength=len(total[m]))
        for m, t in total.items():
            seen = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"m": pa.array(np.full(len(seen), m)), "at": pa.array(seen),
                                              "n": pa.array(t[seen])})

    rows = docs.select("text").mapInArrow(run, "m long, at long, n long").groupBy("m", "at").agg(F.sum("n").alias("n"))
    out = {m: np.zeros(len(known), np.int64) for m, known in windows.tokens.items()}
    for m, at, n in rows.collect():  # as many rows as the block has distinct tokens at most
        out[m][at] = n
    return out


def _find(docs: DataFrame, windows: Windows, counts: dict[int, np.ndarray]) -> DataFrame:
    """Add the hits of one block of items to every document's."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((windows, windows.prefixes(counts)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win, prefixes = shared.value
        lookups = {m: Lookup(np.unique(p[0])) for m, p in prefixes.items()}
        for part in (s for p in parts for s in slices(p)):
            w = Words(part["text"])
            texts = part.num_rows
            doc_of = lambda place: np.searchsorted(w.first, place, "right") - 1
            starts, whiches = [], []
            for m, (token, place, which) in prefixes.items():
                hit, at = lookups[m](w.tokens(m))
                value = lookups[m].known[at]
                low, high = np.searchsorted(token, value), np.searchsorted(token, value, "right")
                n = high - low
                entry = ragged(low, n)
                start, cand = np.repeat(hit, n) - place[entry], which[entry]
                doc = doc_of(np.repeat(hit, n))
                ok = (start >= w.first[doc]) & (start + win.size[cand] <= w.first[doc + 1])
                starts.append(start[ok]), whiches.append(cand[ok])
            start, cand = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, whiches))
            size = win.size[cand]
            of = np.repeat(np.arange(len(start)), size)
            mine, theirs = ragged(start, size), ragged(win.first[cand], size)
            same = w.hash[mine] == win.words[theirs]
            open_ = np.bincount(of, weights=~same, minlength=len(start)) == 0
            sure = open_[of]
            same = w.check(mine[sure]) == win.checks[theirs[sure]]
            open_ &= np.bincount(of[sure], weights=~same, minlength=len(start)) == 0
            start, cand, size = start[open_], cand[open_], size[open_]
            step = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + size, -1)
            old = [part[c] for c in ("starts", "ends", "items")]
            for i in np.flatnonzero([len(x) > 0 for x in old[0].to_pylist()]).tolist() if texts else ():
                for a, z in zip(old[0][i].as_py(), old[1][i].as_py()):
                    step[w.first[i] + a] += 1
                    step[w.first[i] + z] -= 1
            hit = np.cumsum(step[:-1]) > 0
            begin, stop = hit.copy(), hit.copy()
            begin[1:] &= ~hit[:-1]
            stop[:-1] &= ~hit[1:]
            head = w.first[:-1][w.first[1:] > w.first[:-1]]
            tail = w.first[1:][w.first[1:] > w.first[:-1]] - 1
            begin[head], stop[tail] = hit[head], hit[tail]
            begin, stop = np.flatnonzero(begin), np.flatnonzero(stop) + 1
            cuts = np.searchsorted(begin, w.first)
            base = np.repeat(w.first[:-1], np.diff(cuts))
            lists = lambda v: pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(v - base, pa.int64()))
            found: dict[int, set] = {i: set(x) for i, x in enumerate(old[2].to_pylist()) if x}
            for d, c in np.unique(np.stack([doc_of(start), cand], 1), axis=0).tolist():
                found.setdefault(d, set()).update(win.items[c])
            items = pa.array([sorted(found.get(i, ())) for i in range(texts)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part["doc_id"], "text": part["text"], "n_words": pa.array(np.diff(w.first)),
                 "starts": lists(begin), "ends": lists(stop), "items": items}
            )

    return docs.mapInArrow(freed(run), HITS)


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text, n_words, the runs of hit words (starts, ends) and the ids of the items they come from."""
    spark = docs.sparkSession
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    raw = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(raw / block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    empty = lambda t: F.array().cast(f"array<{t}>")
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    hits = plain.withColumns({"n_words": F.lit(0).cast("long"), "starts": empty("long"), "ends": empty("long"),
                              "items": empty("string")})
    for b in range(blocks):
        if b:  # one block's broadcast at a time
            folder = shared_folder(spark, "decontaminate")
            hits.write.parquet(folder)
            hits = spark.read.schema(HITS).parquet(folder)
        block = rows.filter(F.col("block") == b).select("id", "text").collect()  # `block_bytes` on average
        windows = Windows.of([r[0] for r in block], [r[1] for r in block], window)
        hits = _find(hits, windows, _counts(plain, windows))
    return hits


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without those that hold a benchmark window, with the columns of `docs`.

    Rows of one doc_id are judged by their own texts.
    """
    found = find_hits(docs, benchmark, window).filter(F.size("starts") > 0)
    return without(docs, found.select("doc_id", F.xxhash64("text").alias("text_hash")))
