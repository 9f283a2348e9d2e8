"""Near-duplicate documents by ProbMinHash signatures of weighted shingles.

A text's shingles are its runs of five lower-cased words of letters and digits, weighted by how
often they occur.  Every shingle sends arrivals of a Poisson process with its weight as rate, drawn
from its hash alone; each arrival falls on one of `M` registers, and a register keeps the shingle
that arrives first.  A shingle stops when its next arrival is later than the latest register.  Two
texts agree in a register with the probability Jaccard similarity of their weighted shingles.

1. Texts of the same words are one class, whatever their number.
2. Banding: classes that agree in all registers of a band meet in a bucket.  Each member of a bucket
   is verified against the bucket's least member, by the exact probability Jaccard similarity: links
   at `SIMILARITY` or more.  A bucket of n members so costs n - 1 comparisons, not n * n.
3. Buckets whose members are not all of one component by then are compared by their signatures, in
   pairs of blocks.  First each pair of blocks names the maximum spanning forest of its components, by the
   number of agreeing registers: a hub that is nearer to all than they are to each other is found so.  Its
   pairs are verified and the components joined.
4. Buckets that still hold several components are decided in their blocks: members that agree with one of
   another component in `ALIKE` registers, in this band and in none before it, meet with their texts, and the
   task compares each with the others' shingles, joins components at their first link and gives the links of
   a spanning forest.  No pair leaves the task, and each is compared in one band only.
5. Components are named by their smallest doc_id.

Cases: texts without words (null and empty ones too) are classes of their own and link with
nothing; texts of one to four words have one shingle of all their words; rows that repeat a doc_id
are each of their text's class, and `kept` marks one text of a class, that of its smallest doc_id with the
least hash; `one_of_each` leaves one row of it; a null doc_id names no class unless no
other does; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidefold.llm.choose import small, within, without
from tidefold.llm.components import components, forest as forest_of
from tidefold.llm.textbytes import ALNUM, C1, LOWER, SMALL_BYTES, buffer_of, freed, hash_spans, mix, ragged, shingles, slices, word_spans
from tidefold.sinks.folders import shared_folder

WORDS = 5
SIMILARITY = 0.8
M = 128
BAND = 4  # registers of a band: at similarity 0.8 all 32 bands differ once in 10^7
BLOCK = 512
PAIR_BYTES = 1 << 20  # text of the pairs that are verified at once, but for longer pairs
BLOCK_WORDS = 400_000  # of the texts of a block that are compared in a task
# share of agreeing registers of the pairs that a spanning forest is looked for in: three deviations below the
# threshold, which are sqrt(0.8 * 0.2 / 128) each
ESTIMATE = 0.69
# registers in which pairs agree that are compared: six deviations below, missed as rarely as by the bands
ALIKE = 76
SEED = np.uint64(0x51D7348D2C1F9A3B)


def _stored(df: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Shingled:
    """Distinct shingles and their counts, of all texts of a batch in a row."""

    def __init__(self, column, words: int = WORDS):
        data, at = buffer_of(column)
        data = LOWER[data]
        start, end, self.first = word_spans(data, at, ALNUM)
        self.word = hash_spans(data, start, end)
        key, _, doc = shingles(self.word, self.first, words)
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        self.key, self.doc = key[at], doc[at]
        self.count = np.diff(np.append(at, len(key)))
        self.at = np.searchsorted(self.doc, np.arange(len(self.first)))

    def texts(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the words of each text, in order."""
        out = []
        n = np.diff(self.first)
        nth = np.arange(len(self.word)) - np.repeat(self.first[:-1], n)
        for seed in (1, 2):
            h = mix(mix(self.word + np.uint64(seed)) * C1 + nth.astype(np.uint64))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
            out.append(mix(total[self.first[1:]] - total[self.first[:-1]] + n.astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def signatures(key: np.ndarray, count: np.ndarray, doc: np.ndarray, texts: int, m: int = M) -> np.ndarray:
    """The shingle in each register of each text; texts without shingles have 0."""
    latest = np.full(texts, np.inf)
    time, held = np.full(texts * m, np.inf), np.zeros(texts * m, np.uint64)
    x = np.zeros(len(key))
    nth = 0
    while len(key):
        r = mix(key * C1 + SEED + np.uint64(nth))
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / count
        open_ = x < latest[doc]
        key, count, doc, x, r = key[open_], count[open_], doc[open_], x[open_], r[open_]
        place = doc * m + (mix(r ^ SEED) % np.uint64(m)).astype(np.int64)
        np.minimum.at(time, place, x)
        won = x == time[place]
        held[place[won]] = key[won]
        some = np.flatnonzero(np.bincount(doc, minlength=texts)) if len(doc) else doc
        latest[some] = time.reshape(texts, m)[some].max(1)
        open_ = x < latest[doc]
        key, count, doc, x = key[open_], count[open_], doc[open_], x[open_]
        nth += 1
    return held.reshape(texts, m)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets (sorted distinct keys, weights): the sum over common
    elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i)."""
    if not len(a) or not len(b):
        return 0.0
    keys = np.union1d(a, b)
    u, v = np.zeros(len(keys)), np.zeros(len(keys))
    u[np.searchsorted(keys, a)], v[np.searchsorted(keys, b)] = x, y
    with np.errstate(divide="ignore"):
        ratio = u / v
    # where the ratio is as large or larger the first set decides the maximum, else the second
    order = np.argsort(ratio)
    ratio, u, v = ratio[order], u[order], v[order]
    first = np.searchsorted(ratio, ratio, "left")
    above = u.sum() - np.concatenate([[0.0], np.cumsum(u)])[first]
    below = np.concatenate([[0.0], np.cumsum(v)])[first]
    both = (u > 0) & (v > 0)
    return float((1 / (above[both] / u[both] + below[both] / v[both])).sum())


def _signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for p in slices(part, SMALL_BYTES):
            s = Shingled(p["text"])
            one, two = s.texts()
            held = signatures(s.key, s.count, s.doc, p.num_rows)
            short = (mix(held) >> np.uint64(32)).astype(np.uint32)
            band = np.full((p.num_rows, M // BAND), 7, np.uint64)
            for k in range(BAND):
                band = mix(band * C1 + short[:, k::BAND].astype(np.uint64))
            wide = M // BAND
            yield pa.RecordBatch.from_pydict({
                "doc_id": p["doc_id"], "text_hash": p["text_hash"], "n_words": pa.array(np.diff(s.first)), "one": pa.array(one), "two": pa.array(two),
                "bands": pa.ListArray.from_arrays(np.arange(0, p.num_rows * wide + 1, wide, dtype=np.int32),
                                                  pa.array(band.ravel().view(np.int64))),
                "signature": pa.array([r.tobytes() for r in short], pa.binary())})


_SIGNED = "doc_id long, text_hash long, n_words long, one long, two long, bands array<long>, signature binary"


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of classes whose exact similarity is `least` or more."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for p in slices(part, PAIR_BYTES, ("text_a", "text_b")):
                s, t = Shingled(p["text_a"]), Shingled(p["text_b"])
                cut = lambda z, i: slice(z.at[i], z.at[i + 1])
                ok = [similarity(s.key[cut(s, i)], s.count[cut(s, i)], t.key[cut(t, i)], t.count[cut(t, i)]) >= least - 1e-12
                      for i in range(p.num_rows)]
                yield pa.RecordBatch.from_pydict({"a": p["a"], "b": p["b"], "ok": pa.array(ok, pa.bool_())})

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(right, "b").join(left, "a")
    return met.select("a", "b", "text_a", "text_b").mapInArrow(freed(run), "a long, b long, ok boolean")


def _sides(pairs: DataFrame) -> DataFrame:
    """The classes in the pairs."""
    return pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b"))).distinct()


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of every wanted class."""
    wanted = _stored(wanted.join(classes, "class").select("class", "least", "text_hash"), "minhash-wanted")
    rows = docs.select(F.col("doc_id").alias("least"), "text", F.xxhash64("text").alias("text_hash"))
    same = F.struct(F.coalesce("least", F.lit(-(2**63))).alias("id"), "text_hash")
    rows = rows.withColumn("key", same).drop("least", "text_hash")
    wanted = small(wanted.select("class", same.alias("key")))
    found = rows.join(wanted, "key").select("class", "text")
    # rows that repeat a document give its text once
    return found.groupBy("class").agg(F.first("text").alias("text"))


def _spanning(a: np.ndarray, b: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Places of the edges of a maximum spanning forest of components: each tree takes its best edge, again and again."""
    names = np.unique(np.concatenate([a, b]))
    x, y = np.searchsorted(names, a), np.searchsorted(names, b)
    by = np.argsort(-agree, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    tree, open_, out = np.arange(len(names)), np.arange(len(by)), [np.zeros(0, np.int64)]
    while True:
        u, v = tree[x[open_]], tree[y[open_]]
        open_, u, v = open_[u != v], u[u != v], v[u != v]
        if not len(open_):
            return np.concatenate(out)
        best = np.full(len(names), len(by))
        np.minimum.at(best, u, rank[open_])
        np.minimum.at(best, v, rank[open_])
        edges = by[np.unique(best[best < len(by)])]
        out.append(edges)
        tree = forest_of(len(names), tree[x[edges]], tree[y[edges]])[tree]


def _blocks(members: DataFrame, forest: bool) -> DataFrame:
    """Candidate pairs of classes of different components within a bucket, block against block.

    All of them, or a spanning forest of the components for each pair of blocks.
    """
    counted = members.groupBy("band", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(counted, ["band", "bucket"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    need = int(M * ESTIMATE)

    def run(rows: pa.Table) -> pa.Table:
        cls, comp, block = (rows[c].to_numpy() for c in ("class", "component", "block"))
        sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(cls), M)
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b, agree = [], [], []
        for p in left.tolist():
            q = right[(comp[right] != comp[p]) & ((i != j) | (cls[right] > cls[p]))]
            n = (sig[q] == sig[p]).sum(1)
            a.append(np.full(np.count_nonzero(n >= need), p)), b.append(q[n >= need]), agree.append(n[n >= need])
        a, b, agree = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, agree))
        if forest:
            kept = _spanning(comp[a], comp[b], agree)
            a, b = a[kept], b[kept]
        a, b = cls[a], cls[b]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return dealt.groupBy("band", "bucket", "i", "j").applyInArrow(run, "a long, b long").distinct()


class _Met:
    """Members of two blocks of a bucket."""

    def __init__(self, rows: pa.Table):
        self.cls, self.comp, block = (rows[c].to_numpy() for c in ("class", "component", "block"))
        self.sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(self.cls), M)
        self.band, i, j = (rows[c][0].as_py() for c in ("band", "i", "j"))
        self.one = i == j
        self.left, self.right = np.flatnonzero(block == i), np.flatnonzero(block == j)

    def alike(self, p: int, comp: np.ndarray) -> np.ndarray:
        """Members of other components that agree with p in enough registers, and first of all bands in this one."""
        q = self.right[comp[self.right] != comp[p]]
        if self.one:
            q = q[self.cls[q] > self.cls[p]]
        same = self.sig[q] == self.sig[p]
        q, same = q[same.sum(1) >= ALIKE], same[same.sum(1) >= ALIKE]
        bands = same.reshape(len(q), M // BAND, BAND).all(2)
        return q[bands[:, self.band] & ~bands[:, : self.band].any(1)]


def _meeting(members: DataFrame) -> DataFrame:
    """Members of open buckets, by pairs of blocks, that some member of another component is like."""
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_words") / BLOCK_WORDS)).cast("int")
    counted = members.groupBy("band", "bucket").agg(blocks.alias("blocks"))
    dealt = members.join(counted, ["band", "bucket"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    dealt = dealt.select("band", "bucket", "i", "j", "block", "class", "component", "signature")

    def run(rows: pa.Table) -> pa.Table:
        met = _Met(rows)
        some = np.zeros(len(met.cls), bool)
        for p in met.left.tolist():
            q = met.alike(p, met.comp)
            some[q] = True
            some[p] |= len(q) > 0
        return rows.filter(pa.array(some))

    return dealt.groupBy("band", "bucket", "i", "j").applyInArrow(run, dealt.schema)


def _bounds(x: np.ndarray, total: float, key: np.ndarray, count: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """No less than the similarity of a text of weights `x` (by key) with each of some texts.

    In the sum below a common element, common elements count by their sums on either side, not by the larger of
    each; where their weights are in proportion, as with shingles that do not repeat, this is the similarity.
    """
    whole = np.bincount(text, count, texts)
    both = x[key] > 0
    u, v, text = x[key[both]], count[both], text[both]
    first, second = np.bincount(text, u, texts), np.bincount(text, v, texts)
    rest = (total - first)[text] / u + (whole - second)[text] / v
    return np.bincount(text, 1 / (rest + np.maximum(first[text] / u, second[text] / v)), texts)


def _decided(met: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join the components of each pair of blocks, of members and their texts."""

    def run(rows: pa.Table) -> pa.Table:
        m, s = _Met(rows), Shingled(rows["text"])
        _, key = np.unique(s.key, return_inverse=True)
        x = np.zeros(len(s.key))
        size, comp, found = np.diff(s.at, append=len(s.key)), m.comp.copy(), []
        cut = lambda k: slice(s.at[k], s.at[k] + size[k])
        for p in m.left.tolist():
            q = m.alike(p, comp)
            if not len(q):
                continue
            x[key[cut(p)]] = s.count[cut(p)]
            at = ragged(s.at[q], size[q])
            top = _bounds(x, s.count[cut(p)].sum(), key[at], s.count[at], np.repeat(np.arange(len(q)), size[q]), len(q))
            x[key[cut(p)]] = 0
            for k in q[np.flatnonzero(top >= least - 1e-9)[np.argsort(-top[top >= least - 1e-9], kind="stable")]].tolist():
                if comp[k] != comp[p] and similarity(s.key[cut(p)], s.count[cut(p)], s.key[cut(k)], s.count[cut(k)]) >= least - 1e-12:
                    found.append((min(m.cls[p], m.cls[k]), max(m.cls[p], m.cls[k])))
                    comp[comp == comp[k]] = comp[p]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return met.groupBy("band", "bucket", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, n_words, class_id (the smallest doc_id of the group) and kept (doc_id = class_id)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = _stored(hashed.mapInArrow(freed(_signed), _SIGNED), "minhash-signed")
    some = signed.filter("n_words > 0")
    classes = some.groupBy("one", "two").agg(
        F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))),
                   F.min(F.struct("doc_id", "text_hash"))).alias("least"), F.first("bands").alias("bands"),
        F.first("signature").alias("signature"), F.first("n_words").alias("n_words"))
    classes = classes.select("one", "two", "bands", "signature", "n_words", "least.doc_id", "least.text_hash")
    classes = classes.withColumnRenamed("doc_id", "least")
    classes = _stored(classes.withColumn("class", F.monotonically_increasing_id()), "minhash-classes")
    entry = F.posexplode("bands").alias("band", "bucket")
    members = classes.select("class", entry)
    leaders = members.groupBy("band", "bucket").agg(F.min("class").alias("a"), F.count("*").alias("n")).filter("n > 1")
    shared = _stored(members.join(leaders.select("band", "bucket", "a"), ["band", "bucket"]), "minhash-buckets")
    pairs = _stored(shared.filter("a < class").select("a", F.col("class").alias("b")).distinct(), "minhash-pairs")
    done = _stored(_verify(pairs, _texts(rows, classes, _sides(pairs)), least), "minhash-verified")
    links = done.filter("ok").select("a", "b")
    left = _open(shared, classes, links)
    more = _stored(_blocks(left, True).join(done.select("a", "b"), ["a", "b"], "left_anti"), "minhash-pairs")
    again = _stored(_verify(more, _texts(rows, classes, _sides(more)), least), "minhash-verified")
    links = links.union(again.filter("ok").select("a", "b"))
    met = _stored(_meeting(_open(shared, classes, links)), "minhash-met")
    met = met.join(_texts(rows, classes, met.select("class").distinct()), "class")
    links = links.union(_stored(_decided(met, least), "minhash-links"))
    parts = components(links).withColumnRenamed("id", "class")
    named = classes.select("one", "two", "class", "least", "text_hash").join(parts, "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    first = F.min(F.struct(F.col("least").isNull(), "least", "text_hash")).alias("first")
    names = named.groupBy("component").agg(first).select("component", F.col("first.least").alias("class_id"), F.col("first.text_hash").alias("chosen"))
    of = named.join(names, "component").select("one", "two", "class_id", "chosen")
    columns = ["doc_id", "text_hash", "n_words"]
    out = some.select(*columns, "one", "two").join(of, ["one", "two"]).select(*columns, "class_id", "chosen")
    alone = signed.filter("n_words = 0").select(*columns, F.col("doc_id").alias("class_id"), F.col("text_hash").alias("chosen"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_hash").eqNullSafe(F.col("chosen"))
    return out.unionByName(alone).withColumn("kept", kept).drop("chosen")


def _open(shared: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component of the links."""
    parts = _stored(components(links), "minhash-components").withColumnRenamed("id", "class")
    labelled = shared.join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    open_ = labelled.groupBy("band", "bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = open_.filter("x < y").select("band", "bucket")
    rows = labelled.join(open_, ["band", "bucket"]).join(classes.select("class", "signature", "n_words"), "class")
    return rows.select("band", "bucket", "class", "component", "signature", "n_words")


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents, all their columns: one row of each group, with its smallest doc_id.

    Where rows repeat that id and text, the least of them, as JSON, stays.
    """
    found = near_duplicates(docs, least)
    found = _stored(found.groupBy("doc_id", "text_hash").agg(
        F.first("kept").alias("kept"), F.sum(F.when(F.col("n_words") > 0, 1).otherwise(0)).alias("n")), "minhash-found")
    left = without(docs, found.filter("not kept or n > 1").select("doc_id", "text_hash"))
    repeated = within(docs, found.filter("kept and n > 1").select("doc_id", "text_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    key = [F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash")]
    one = repeated.select(*key, row.alias("row")).groupBy("id", "hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.union(one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
