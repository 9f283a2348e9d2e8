"""Collocations of two to five words, mined by SON partitioning.

A phrase that occurs `support` times among all documents of a language occurs, in some shard, at
least `support` times the shard's share of them.  So

1. documents are dealt to a fixed number of shards, and each shard's share of a language is its share
   of bytes of text;
2. each shard is mined completely at its own support, lowered in proportion: words and pairs first,
   then longer phrases whose pairs are all frequent in the shard;
3. the phrases that are frequent in some shard are united, and all of them are counted in all documents.

A shard is no task: its counts are aggregated by Spark over (hash, shard), after every task has
counted its own documents, so that shards may be of any size and their number, hence the local support,
does not depend on the input.  Few shards keep that support high, and the candidates few.  Steps 2 and 3 know frequent hashes by a bitmap of bounded size (at
most `BITS` bits, broadcast).  A bit that another hash has set lets too much pass, never too little,
and step 3 counts the words themselves.  The hashes of mining decide candidates only: where two
phrases share one, it is counted too high.

`collocations` then scores every candidate by its lowest cut and drops those that a longer one
explains; `count_phrases` gives the counts alone.

Cases: a null text is empty; a null language is `und`; words and texts may be of any length; rows
without id form a block of their own; repeated rows count as often as they occur; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidefold.llm.textbytes import C1, LOWER, buffer_of, hash_spans, mix, slices, word_spans
from tidefold.sinks.folders import shared_folder

SUPPORT = 100
LONGEST = 5
SHARDS = 5
BLOCK = 4096  # ids that follow each other are in one shard, so that a slice counts for few shards
SLICE = 2 << 20
HELD = 2_000_000  # counts that a task holds before it passes them on
HELD_TEXTS = 400_000  # and phrases
TASK_BYTES = 64 << 20  # text that one task counts candidates in, so that it passes on a frequent phrase once for all of it
BITS = 28  # a bitmap has 2 to the power of this many bits at most (32 MB)
TOP = 2000

# fixed values: bytes that end a piece, and those between words
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~ENDS
WORD[[0x20, 0x09]] = False


class Words:
    """The words of a slice: their bytes, hashes, documents and pieces."""

    def __init__(self, rows: pa.RecordBatch, twice: bool = False):
        data, at = buffer_of(rows["text"])
        self.data = LOWER[data]
        self.start, self.end, self.first = word_spans(self.data, at, WORD)
        self.doc = np.repeat(np.arange(rows.num_rows), np.diff(self.first))
        marks = np.cumsum(ENDS[self.data], dtype=np.int32)
        # both grow along the text, so that equal sums mean equal pieces
        self.piece = marks[self.start] + self.doc if len(self.start) else np.zeros(0, np.int64)
        self.hash = hash_spans(self.data, self.start, self.end)
        if twice:
            self.other, self.raw = hash_spans(self.data, self.start, self.end, 1), self.data.tobytes()
        self.lang = rows["lang_hash"].to_numpy().view(np.uint64)

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash with the language) of all phrases of k words."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:n] == self.piece[k - 1 :])
        h = mix(self.lang[self.doc[at]] + np.uint64(k))
        for j in range(k):
            h = mix(h * C1 + self.hash[at + j])
        return at, h


def _shard_bits(h: np.ndarray, shard: np.ndarray | int) -> np.ndarray:
    """The number that stands for a hash within a shard."""
    return h ^ (np.asarray(shard).astype(np.uint64) * np.uint64(2654435761))


class Bitmap:
    """Hashes that may be among those of a table: `of` numbers (long)."""

    def __init__(self, df: DataFrame, of: Column):
        count = df.count()
        # some 2^-8 of other hashes pass while the table has less than 2^(BITS - 8) rows
        self.bits = min(BITS, max(16, int(count * 256).bit_length()))
        place = of.bitwiseAND(F.lit((1 << self.bits) - 1)) + F.lit(1)
        pages = df.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        size = 4096  # bytes of Spark's bitmaps
        held = np.zeros(max(size, 1 << (self.bits - 3)), np.uint8)
        for page, bits in pages.toLocalIterator():
            held[(page - 1) * size : page * size] = np.frombuffer(bits, np.uint8)
        self.shared = df.sparkSession.sparkContext.broadcast(held)

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        held, low = self.shared.value, np.uint64((1 << self.bits) - 1)

        def may_hold(h: np.ndarray) -> np.ndarray:
            place = h & low
            return (held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0

        return may_hold


# -- mining shards --------------------------------------------------------------------

COUNTS = "h long, shard int, need int, c int"


class Counts:
    """Counts of hashes by shard, of the slices of a task."""

    def __init__(self):
        self.parts: dict[int, list[tuple[np.ndarray, ...]]] = {}
        self.size = 0

    def add(self, shard: int, h: np.ndarray, need: np.ndarray, count: np.ndarray) -> None:
        self.parts.setdefault(shard, []).append((h, need, count))
        self.size += len(h)

    def merge(self) -> None:
        self.size = 0
        for shard, parts in self.parts.items():
            h, need, count = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(h)
            h, need, count = h[order], need[order], count[order]
            head = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            count = np.add.reduceat(count, head) if len(h) else count
            self.parts[shard] = [(h[head], need[head], count)]
            self.size += len(head)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for shard, ((h, need, count),) in self.parts.items():
            for a in range(0, len(h), 100_000):
                z = a + 100_000
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(h[a:z].view(np.int64)), "shard": pa.array(np.full(len(h[a:z]), shard, np.int32)),
                    "need": pa.array(need[a:z]), "c": pa.array(count[a:z].astype(np.int32))})
        self.parts, self.size = {}, 0


def _mined(lengths: range, pairs: Bitmap | None):
    """Counts of a task's phrases, by shard; longer ones only where all their pairs may be frequent there."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, held, most = pairs.test() if pairs else None, Counts(), HELD
        for part in parts:
            for rows in slices(part, SLICE):
                words = Words(rows)
                shard, need = rows["shard"].to_numpy(), rows["need"].to_numpy()
                if test:
                    at, h = words.phrases(2)
                    good = np.zeros(len(words.hash) + LONGEST, bool)
                    good[at] = test(_shard_bits(h, shard[words.doc[at]]))
                for k in lengths:
                    at, h = words.phrases(k)
                    if test:
                        ok = np.logical_and.reduce([good[at + j] for j in range(k - 1)])
                        at, h = at[ok], h[ok]
                    of = shard[words.doc[at]]
                    for s in np.unique(of).tolist():
                        # a shard's documents of different languages have different hashes
                        m = np.flatnonzero(of == s)
                        key, one, count = np.unique(h[m], return_index=True, return_counts=True)
                        held.add(s, key, need[words.doc[at[m[one]]]], count.astype(np.int32))
                if held.size > most:
                    held.merge()
                    if held.size > HELD // 2:
                        yield from held.rows()
                    most = max(HELD, 2 * held.size)
        held.merge()
        yield from held.rows()

    return run


def _frequent(rows: DataFrame, lengths: range, pairs: Bitmap | None, folder: str) -> DataFrame:
    """(h, shard) that reach the support of their shard."""
    counts = rows.select("text", "lang_hash", "shard", "need").mapInArrow(_mined(lengths, pairs), COUNTS)
    found = counts.groupBy("h", "shard").agg(F.sum("c").alias("c"), F.min("need").alias("need")).filter("c >= need")
    found.select("h", "shard").write.parquet(folder)
    return rows.sparkSession.read.schema("h long, shard int").parquet(folder)


# -- counting candidates --------------------------------------------------------------

PHRASES = "lang string, k int, phrase string, c long"


class Phrases:
    """Phrases and their counts, of the slices of a task; equal where two hashes are, 128 bits together."""

    def __init__(self):
        self.known = np.zeros(0, [("h", "<u8"), ("check", "<u8")])
        self.entry = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.lang: list[str] = []
        self.k: list[int] = []
        self.phrase: list[str] = []

    def add(self, words: Words, lang: list[str], k: int, at: np.ndarray, h: np.ndarray) -> None:
        if not len(at):
            return
        check = words.lang[words.doc[at]] + np.uint64(k)
        for j in range(k):  # another hash of the same words
            check = mix((check ^ words.other[at + j]) * C1)
        order = np.lexsort((check, h))
        key = np.empty(len(at), self.known.dtype)
        key["h"], key["check"] = h[order], check[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count, key, at = np.diff(np.append(head, len(order))), key[head], at[order[head]]
        where = np.searchsorted(self.known["h"], key["h"])
        old = np.zeros(len(key), bool)
        inside = where < len(self.known)
        old[inside] = self.known[where[inside]] == key[inside]
        # a hash that another phrase has taken: a second entry, which later counts may miss and repeat, and Spark adds up
        self.count[self.entry[where[old]]] += count[old]
        new = np.flatnonzero(~old)
        raw, s, e = words.raw, words.start, words.end
        for i in at[new].tolist():
            self.phrase.append(b" ".join([raw[a:z] for a, z in zip(s[i : i + k].tolist(), e[i : i + k].tolist())]).decode())
        self.lang += [lang[d] for d in words.doc[at[new]].tolist()]
        self.k += [k] * len(new)
        self.known = np.insert(self.known, where[new], key[new])
        self.entry = np.insert(self.entry, where[new], len(self.count) + np.arange(len(new)))
        self.count = np.append(self.count, count[new])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.k), 50_000):
            z = a + 50_000
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(self.lang[a:z], pa.string()), "k": pa.array(self.k[a:z], pa.int32()),
                "phrase": pa.array(self.phrase[a:z], pa.string()), "c": pa.array(self.count[a:z])})


def _counted(candidates: Bitmap):
    """Counts of a task's phrases that may be candidates (their words, shorter phrases and themselves), and of its words (k 0)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, held, totals = candidates.test(), Phrases(), Counter()
        for part in parts:
            for rows in slices(part, SLICE):
                words = Words(rows, twice=True)
                lang = rows["lang"].to_pylist()
                before = None
                for k in range(1, LONGEST + 1):
                    at, h = words.phrases(k)
                    ok = test(h)
                    if before is not None:  # both phrases of one word less
                        ok &= before[at] & before[at + 1]
                    at, h = at[ok], h[ok]
                    before = np.zeros(len(words.hash) + 1, bool)
                    before[at] = True
                    held.add(words, lang, k, at, h)
                for name, n in zip(lang, np.diff(words.first).tolist()):
                    totals[name] += n
                if len(held.k) > HELD_TEXTS:
                    yield from held.rows()
                    held = Phrases()
        yield from held.rows()
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(totals), pa.string()), "k": pa.array([0] * len(totals), pa.int32()),
            "phrase": pa.nulls(len(totals), pa.string()), "c": pa.array(list(totals.values()), pa.int64())})

    return run


def count_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """(lang, k, phrase, c): every phrase of up to five words that occurs `support` times in its language, and the words of all (k 0)."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "phrases")
    block = F.floor(F.col("doc_id").cast("long") / BLOCK)
    rows = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(block), F.lit(shards)).cast("int").alias("shard"))
    rows = rows.withColumn("lang_hash", F.xxhash64("lang"))
    # a shard's support: its share of the language's bytes, rounded up
    sizes = rows.groupBy("lang", "shard").agg(F.sum(F.octet_length("text")).alias("bytes"))
    sizes.write.parquet(f"{folder}/sizes")
    sizes = spark.read.schema(sizes.schema).parquet(f"{folder}/sizes")
    whole = sizes.groupBy("lang").agg(F.sum("bytes").alias("all"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    need = F.ceil(F.lit(support).cast("decimal(10,0)") * exact("bytes") / F.greatest(exact("all"), F.lit(1))).cast("int")
    needs = sizes.join(whole, "lang").select("lang", "shard", F.greatest(need, F.lit(1)).alias("need"))
    dealt = rows.join(needs, ["lang", "shard"])
    number = F.col("h").bitwiseXOR(F.col("shard").cast("long") * F.lit(2654435761))
    short = _frequent(dealt, range(1, 3), None, f"{folder}/short")
    pairs = Bitmap(short, number)
    long = _frequent(dealt, range(3, LONGEST + 1), pairs, f"{folder}/long")
    candidates = short.select("h").union(long.select("h")).distinct()
    candidates.write.parquet(f"{folder}/candidates")
    candidates = Bitmap(spark.read.schema("h long").parquet(f"{folder}/candidates"), F.col("h"))
    tasks = max(2 * spark.sparkContext.defaultParallelism, (sizes.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES)
    counts = rows.select("text", "lang", "lang_hash").coalesce(tasks).mapInArrow(_counted(candidates), PHRASES)
    counts = counts.groupBy("lang", "k", "phrase").agg(F.sum("c").alias("c")).filter((F.col("c") >= support) | (F.col("k") == 0))
    counts.write.parquet(f"{folder}/counts")
    return spark.read.schema(PHRASES).parquet(f"{folder}/counts")


# -- scores ---------------------------------------------------------------------------


def _part(a: Column, n: Column) -> Column:
    """n words of the phrase from word a (1, 2, ...) on."""
    return F.array_join(F.slice("w", a, n), " ")


def scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of every phrase of two words and more, by its lowest cut."""
    total = counts.filter("k = 0").select("lang", F.col("c").alias("n"))
    known = counts.filter("k > 0").select("lang", "phrase", "c")
    named = counts.filter("k > 1").select("lang", "phrase", "k", F.col("c").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = named.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", _part(F.lit(1), F.col("cut")).alias("left"),
                       _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    side = lambda name, c: known.select("lang", F.col("phrase").alias(name), F.col("c").alias(c))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(total, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("above", (big("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * big("n"))
    cuts = cuts.withColumn("below", big("l") * big("r")).withColumn("score", F.expr("above div below"))
    best = F.min(F.struct("score", "cut", "l", "r", "n", "a", "k")).alias("best")
    return cuts.groupBy("lang", "phrase").agg(best).select(
        "lang", "phrase", *[F.col("best")[c].alias(c) for c in ("k", "a", "l", "r", "n", "score")])


def explained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): phrases inside longer candidates, with the largest count of one of those."""
    named = counts.filter("k > 2").select("lang", "k", "c", F.split("phrase", " ").alias("w"))
    inner = named.select("lang", "k", "c", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("n"))
    inner = inner.select("lang", "c", "w", "n", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("n") + 1)).alias("a"))
    inner = inner.select("lang", "c", _part(F.col("a"), F.col("n")).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("c").alias("longer"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = count_phrases(docs, support, shards)
    kept = scores(counts).join(explained(counts), ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of parts of a language, then of those
    spread = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    spread = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
