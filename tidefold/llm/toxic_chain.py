"""Toxicity by a classifier chain over labelled categories.

Categories are predicted one after the other; the model of each sees the words of a text and
the probabilities of the earlier categories.  In training these are out-of-fold predictions:
each labelled row is judged by models that have not seen it, as later rows are.

Features of a text are the presence of lower-cased words of letters and digits and of word
beginnings of 3 to 6 bytes, and a few measures of the whole text.  The words used are chosen by a
likelihood-ratio test against each category over all labelled documents; the linear models
(logistic, ridge, Newton steps) are fitted on at most `SAMPLE_ROWS` labelled documents, the
bounded sample, those with the least hashes of their id.  Every document is scored on its whole text.

Cases: documents without a label train nothing; several labels of one doc_id count by their
maximum, a null label not at all, while the row's other labels count; a null or empty text has no features and is scored by the
intercepts; repeated documents train and are scored as often as they are there; a category
that has one class only is predicted by its share; without any label nothing is toxic; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidefold.llm.choose import small
from tidefold.llm.decontaminate import Lookup
from tidefold.llm.exchange import unique
from tidefold.llm.textbytes import ALNUM, LOWER, SMALL_BYTES, buffer_of, freed, hash_spans, slices, word_spans

SAMPLE_ROWS = 20_000
WORDS_PER_CATEGORY = 150
MIN_DOCS = 3
LEAST_GAIN = 25.0  # of the likelihood-ratio test
FOLDS = 5
RIDGE = 0.1
AFFIXES = (3, 4, 5, 6)
REJECT = 0.5
MEASURES = 4


def categories() -> dict[str, Column]:
    """The categories of the labels table, in the order of the chain."""
    return {"low_quality": (F.col("quality") == 0).cast("int"), "toxic": (F.col("toxic") == 1).cast("int")}


class _Features:
    """Distinct feature hashes of every text of a batch, and its measures."""

    def __init__(self, column):
        data, at = buffer_of(column)
        data = LOWER[data]
        start, end, first = word_spans(data, at, ALNUM)
        texts, n = len(at) - 1, np.diff(first)
        size = end - start
        doc = np.repeat(np.arange(texts), n)
        word, of = unique(hash_spans(data, start, end))
        # one of each word of a text is enough
        pair = np.unique(doc * np.int64(len(word) + 1) + of)
        pair_doc, pair_word = pair // (len(word) + 1), pair % (len(word) + 1)
        docs, keys = [pair_doc], [word[pair_word]]
        one = np.zeros(len(word), np.int64)
        one[of] = np.arange(len(of))
        for k in AFFIXES:
            long = size[one] > k
            hashes = np.zeros(len(word), np.uint64)
            hashes[long] = hash_spans(data, start[one[long]], start[one[long]] + k, 100 + k)
            m = long[pair_word]
            docs.append(pair_doc[m]), keys.append(hashes[pair_word[m]])
        self.doc, self.key = np.concatenate(docs), np.concatenate(keys)
        letters = np.bincount(doc, weights=size, minlength=texts)
        total = np.maximum(n, 1)
        distinct = np.bincount(pair_doc, minlength=texts)
        bytes_ = np.maximum(np.diff(at), 1)
        self.measures = np.stack([np.log1p(n), letters / total, distinct / total, letters / bytes_], 1)

    def counted(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features, and per feature the sums of the rows' weights over the texts that have it."""
        key, of = unique(self.key)
        # a beginning is shared by several words of a text: count the text once
        pair = np.unique(of * np.int64(len(self.measures) + 1) + self.doc)
        of, doc = pair // (len(self.measures) + 1), pair % (len(self.measures) + 1)
        return key, np.stack([np.bincount(of, weights=w[doc], minlength=len(key)) for w in weights], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Linear:
    """A logistic model of standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> "Linear":
        n, k = x.shape
        mean, scale = (x.mean(0), x.std(0)) if n else (np.zeros(k), np.ones(k))
        scale = np.where(scale > 1e-9, scale, 1.0)
        share = (y.sum() + 0.5) / (n + 1)
        out = Linear(mean, scale, np.zeros(k), float(np.log(share / (1 - share))))
        if not n or y.min() == y.max():
            return out
        z = np.concatenate([(x - mean) / scale, np.ones((n, 1))], 1)
        w = np.append(out.weight, out.bias)
        penalty = np.append(np.full(k, ridge), 0.0)
        for _ in range(steps):
            p = _sigmoid(z @ w)
            gradient = z.T @ (p - y) + penalty * w
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6)
            step = np.linalg.solve(curve, gradient)
            step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
            w = w - step
            if np.abs(step).max() < 1e-4:
                break
        out.weight, out.bias = w[:-1], float(w[-1])
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight + self.bias


@dataclass
class Chain:
    """Chosen features and one linear model per category; each takes the probabilities of those before it."""

    names: list[str]
    known: np.ndarray
    models: list[Linear]

    @staticmethod
    def fit(names: list[str], known: np.ndarray, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> "Chain":
        models, extra = [], np.zeros((len(x), 0))
        for k in range(len(names)):
            full = np.concatenate([x, extra], 1)
            told = ~np.isnan(y[:, k])  # rows that have this label; the others are judged all the same
            models.append(Linear.fit(full[told], y[told, k]))
            unseen = np.zeros(len(x))
            for f in range(FOLDS):
                here = fold == f
                if here.any():
                    unseen[here] = _sigmoid(Linear.fit(full[~here & told], y[~here & told, k]).logit(full[here]))
            extra = np.concatenate([extra, unseen[:, None]], 1)
        return Chain(names, known, models)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A probability per text and category."""
        extra = np.zeros((len(x), 0))
        for m in self.models:
            extra = np.concatenate([extra, _sigmoid(m.logit(np.concatenate([x, extra], 1)))[:, None]], 1)
        return extra


def _matrix(f: _Features, lookup: Lookup) -> np.ndarray:
    place, at = lookup(f.key)
    x = np.zeros((len(f.measures), len(lookup.known) + MEASURES))
    x[f.doc[place], at] = 1.0
    x[:, len(lookup.known) :] = f.measures
    return x


def label_rows(labels: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """doc_id and an array `y` of the categories, null where unknown, of ids that have any label; broadcast if few."""
    y = labels.select("doc_id", *[c.alias(f"y{i}") for i, c in enumerate(by.values())]).groupBy("doc_id")
    y = y.agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(by))]).dropna("all", subset=[f"y{i}" for i in range(len(by))])
    return small(y.filter("doc_id IS NOT NULL").select("doc_id", F.array(*[f"y{i}" for i in range(len(by))]).alias("y")))


def choose(rows: DataFrame, n: int) -> np.ndarray:
    """Hashes of the features that tell categories apart, by counts over all labelled documents."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for p in slices(part):
                y = np.array(p["y"].to_pylist(), float).reshape(-1, n)
                key, sums = _Features(p["text"]).counted([*(~np.isnan(y)).T.astype(float), *np.nan_to_num(y).T])
                yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64)), **{
                    c: pa.array(sums[:, i].astype(np.int64)) for i, c in enumerate(counts)}})

    counts = [*[f"n{i}" for i in range(n)], *[f"s{i}" for i in range(n)]]  # texts with the label, texts of the category
    sums = rows.select("text", "y").mapInArrow(freed(run), ", ".join(["key long", *[f"{c} long" for c in counts]])).groupBy("key")
    sums = sums.agg(*[F.sum(c).alias(c) for c in counts])
    all_ = rows.agg(*[F.count(F.col("y")[i]) for i in range(n)], *[F.sum(F.col("y")[i]) for i in range(n)]).first()
    gains = []
    for i in range(n):
        has, pos, docs, yes = F.col(f"n{i}").cast("double"), F.col(f"s{i}").cast("double"), float(all_[i]), float(all_[n + i] or 0)

        def part(seen: Column, expected: Column) -> Column:
            return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

        g = (part(pos, has * yes / docs) + part(has - pos, has * (docs - yes) / docs)
             + part(yes - pos, (docs - has) * yes / docs) + part(docs - has - (yes - pos), (docs - has) * (docs - yes) / docs)
             ) if 0 < yes < docs else F.lit(0.0)
        gains.append(F.when(F.col(f"n{i}") >= MIN_DOCS, g).otherwise(0.0).alias(f"g{i}"))
    # the best of each category: a few rows
    table = sums.select("key", *gains)
    best = set()
    for i in range(n):
        top = table.filter(F.col(f"g{i}") >= LEAST_GAIN).orderBy(F.desc(f"g{i}"), "key").limit(WORDS_PER_CATEGORY)
        best |= {r[0] for r in top.select("key").collect()}
    return np.sort(np.array(sorted(best), np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, by: Mapping[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> Chain:
    by = by or categories()
    names, n = list(by), len(by)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known_labels = label_rows(labels, by)
    rows = docs.join(known_labels, "doc_id")
    count = rows.count()
    if not count:
        none = Linear(np.zeros(0), np.ones(0), np.zeros(0), -35.0)
        return Chain(names, np.zeros(0, np.uint64), [
            Linear(np.zeros(MEASURES + k), np.ones(MEASURES + k), np.zeros(MEASURES + k), none.bias) for k in range(n)])
    known = choose(rows, n)
    lookup = Lookup(known)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in (s for part in parts for s in slices(part, SMALL_BYTES)):
            x = _matrix(_Features(p["text"]), lookup)
            raw = [r.tobytes() for r in np.packbits(x[:, : len(known)] > 0, axis=1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": p["doc_id"], "y": p["y"], "words": pa.array(raw, pa.binary()),
                "measures": pa.array(x[:, len(known) :].tolist(), pa.list_(pa.float64()))})

    # the documents of the sample: their least hash, in a number of hash ranges that holds enough
    hash_ = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    share = min(1.0, 1.5 * sample_rows / count) * (1 << 20)
    chosen = rows.filter(hash_ < share).select("doc_id", "text", "y")
    made = chosen.mapInArrow(freed(run), "doc_id long, y array<int>, words binary, measures array<double>")
    got = made.orderBy(F.xxhash64("doc_id"), "doc_id", "words").limit(sample_rows).toArrow()
    bits = np.frombuffer(b"".join(got["words"].to_pylist()), np.uint8).reshape(got.num_rows, -1)
    x = np.unpackbits(bits, axis=1, count=len(known)).astype(float) if len(known) else np.zeros((got.num_rows, 0))
    x = np.concatenate([x, np.array(got["measures"].to_pylist()).reshape(-1, MEASURES)], 1)
    y = np.array(got["y"].to_pylist(), float).reshape(-1, n)
    ids = np.array(got["doc_id"].to_pylist(), np.int64)
    # copies of one document share a fold
    return Chain.fit(names, known, x, y, (ids % FOLDS + FOLDS) % FOLDS)


def _scored(part: pa.RecordBatch, chain: Chain, lookup: Lookup) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for p in slices(part, SMALL_BYTES):
        yield p, chain.predict(_matrix(_Features(p["text"]), lookup))


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id and the probability p_<name> of every category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # some hundred features

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, lookup = shared.value, Lookup(shared.value.known)
        for part in parts:
            for p, out in _scored(part, chain, lookup):
                yield pa.RecordBatch.from_pydict({"doc_id": p["doc_id"], **{
                    f"p_{c}": pa.array(out[:, i], pa.float64()) for i, c in enumerate(chain.names)}})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(freed(run), "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.names))


def without(docs: DataFrame, chain: Chain, category: str = "toxic", reject: float = REJECT) -> DataFrame:
    """The documents, all their columns, whose probability of the category is below `reject`."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = chain.names.index(category)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, lookup = shared.value, Lookup(shared.value.known)
        for part in parts:
            for p, out in _scored(part, chain, lookup):
                yield p.filter(pa.array(out[:, at] < reject))

    return docs.mapInArrow(freed(run), docs.schema)
