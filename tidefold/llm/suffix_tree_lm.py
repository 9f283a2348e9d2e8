"""Probabilistic suffix tree over words: contexts of variable length, kept where they tell something.

Symbols are the lower-cased words of a text and one end; a text starts after a start symbol.
The root gives each symbol its smoothed share of the training tokens.  A context of any
length is a candidate where it occurs twice in training.  It is retained if its next
symbols diverge from what its longest shorter context predicts: the sum over its occurrences
of the log ratio of both predictions, each occurrence left out of its own count, exceeds
`gain` nats.  (That is the count times the divergence of the two distributions, without the
bias of small counts.)  A retained state predicts

    P(w | s) = (c(s, w) + alpha * P(w | shorter)) / (c(s) + alpha)

and a text is scored by the longest retained suffix at each symbol.

Contexts grow by one symbol per level to `depth` symbols, or until none is left.  From three symbols on
only contexts are counted that can lead to a retained one: an occurrence of a longer context before w gains
at most log((C - 1 + alpha * p) / ((C - 1 + alpha) * p)), C being c(s, w) and p the prediction so far, since c / n
of the longer one is at most C / C.  None of these terms is negative, so where their sum over the occurrences
of s in training does not exceed `gain`, neither does the divergence of any context that ends in s.  Counts are of the whole
training corpus, without caps; candidates, states and next symbols grow with it.

From two symbols on a count is asked for only where shorter ones do not tell it.  A context is the one before with its next
symbol, which the level before has counted.  After a context that occurs as often as its shorter one, symbols do too; a symbol that
never follows the shorter one follows no longer one; and where the shorter one with its symbol is at one place of all texts,
so is the longer one.  Each of these holds at all places of an n-gram or at none, so that what is asked for is counted whole.
Nor is the divergence of a context asked for where each place knows all the others (`_sure`).

Cases: a null text is empty and has its end as only token; a null doc_id counts as the
empty text in the split (held out); repeated rows count as often as they are there; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidefold.llm.exchange import ASKED, Batches, answer, ids_of, joined, pack, question, summed, unique, unpack
from tidefold.llm.textbytes import C1, LOWER, SPACED, buffer_of, hash_spans, mix, word_spans
from tidefold.sinks import folders

FOLDS = 10
ADD = 0.1
ALPHA = 1.0
GAIN = 2.0
_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)  # no word's hash but by chance of 1 in 2^64


def held_out(ids: pa.Array, folds: int = FOLDS) -> np.ndarray:
    """Whether crc32 of the id as text, modulo `folds`, is 0."""
    texts = ("" if i is None else str(i) for i in ids.to_pylist())
    return np.fromiter((zlib.crc32(t.encode()) % folds == 0 for t in texts), bool, len(ids))


class _Texts:
    """The symbols of a batch in a row, with the facts that answers have brought so far."""

    def __init__(self, table: pa.Table):
        self.ids = table["doc_id"].combine_chunks().flatten()
        n, held, self.one, of = unpack(table["symbols"][0].as_py())
        self.held, self.of = held > 0, of.astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(n)])
        self.symbol = self.one[self.of]
        self.train = np.repeat((~self.held).astype(np.int64), n)
        self.token = np.ones(len(self.symbol), bool)
        self.token[self.at[:-1]] = False

    @staticmethod
    def prepared(folds: int):
        """What a batch stores of its documents: their words are hashed, and sorted, once for all passes."""

        def run(table: pa.Table) -> pa.Table:
            _, ids = ids_of(table)
            data, at = buffer_of(table["text"])
            data = LOWER[data]
            start, end, first = word_spans(data, at, SPACED)
            n = np.diff(first)
            at = np.concatenate([[0], np.cumsum(n + 2)])
            symbol = np.empty(at[-1], np.uint64)
            symbol[at[:-1]] = _START
            symbol[at[1:] - 1] = _END
            doc = np.repeat(np.arange(len(n)), n)
            symbol[np.arange(len(start)) + 2 * doc + 1] = hash_spans(data, start, end)
            one, of = unique(symbol)
            arrays = pack(n + 2, held_out(ids, folds).astype(np.uint8), one, of.astype(np.int32))
            return pa.table({"doc_id": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "symbols": pa.array([arrays], pa.binary())})

        return run

    def ones(self) -> tuple[np.ndarray, np.ndarray]:
        return self.one, np.bincount(self.of, weights=self.train, minlength=len(self.one)).astype(np.int64)

    def set_ones(self, counts: np.ndarray, tokens: int, words: int) -> None:
        self.counts, self.c1 = counts, counts[self.of]  # of each symbol, and of the symbol at each place
        self.p0 = ((counts + ADD) / (tokens + ADD * (words + 1)))[self.of]
        self.j = np.flatnonzero(self.token)
        self.j = self.j[self.c1[self.j - 1] >= 2]  # places after a candidate context of one symbol

    def pairs(self) -> None:
        self.two, self.of2 = unique(mix((mix(self.one) * C1)[self.of[self.j - 1]] + self.symbol[self.j]))

    def twos(self) -> tuple[np.ndarray, ...]:
        return self.two, *_places(self.of2, self.train[self.j], len(self.two))

    def set_twos(self, seen2: np.ndarray) -> np.ndarray:
        """What is known of the pair that ends at j; the pairs that are followed by k are given back."""
        self.seen2, self.c2 = seen2, seen2 >> 2
        # places after a candidate context of two symbols; such a place follows one in j, and is the next one there
        i = np.flatnonzero(self.c2 >= 2)
        i = i[np.append(self.token, False)[self.j[i] + 1]]
        self.k, self.c12, self.seen12, self.seen3 = self.j[i] + 1, self.c2[i], seen2[i], seen2[i + 1]
        return i

    def triples(self, i: np.ndarray) -> None:
        self.of12 = of = self.of2[i]
        self.open3 = np.flatnonzero(~_told(self.seen3, self.c12, self.c1[self.k - 1]))
        self.three, self.of3 = unique(mix((mix(self.two) * C1)[of[self.open3]] + self.symbol[self.k[self.open3]]))

    def threes(self) -> tuple[np.ndarray, ...]:
        return self.three, *_places(self.of3, self.train[self.k[self.open3]], len(self.three))

    def set_threes(self, seen: np.ndarray) -> None:
        """What is known of the triple that ends at k."""
        self.seen3[self.open3] = seen[self.of3]
        self.sure = _sure(self.seen12, self.seen3 >> 2)
        used, of = np.zeros(len(self.two), bool), self.of12[~self.sure]
        used[of] = True
        self.context, self.of_context = self.two[used], (np.cumsum(used) - 1)[of]

    def gains1(self) -> tuple[np.ndarray, np.ndarray]:
        """This batch's part of the divergence of each context of one symbol."""
        gain = _gain(self.c2, self.c1[self.j - 1], self.p0[self.j]) * self.train[self.j]
        total = np.bincount(self.of[self.j - 1], weights=gain, minlength=len(self.one))
        used = np.bincount(self.of[self.j - 1], minlength=len(self.one)) > 0
        return self.one[used], total[used]

    def set_gains1(self, retained: np.ndarray) -> None:
        used = np.bincount(self.of[self.j - 1], minlength=len(self.one)) > 0
        self.kept = np.zeros(len(self.one), np.uint8)
        self.kept[used] = retained
        self.set_kept()

    def set_kept(self) -> None:
        kept = self.kept[self.of[self.j - 1]] > 0
        self.depth = np.zeros(len(self.symbol), np.int64)
        self.depth[self.j[kept]] = 1
        self.p = self.p0.copy()
        self.p[self.j[kept]] = _smoothed(self.c2[kept], self.c1[self.j[kept] - 1], self.p0[self.j[kept]])

    def facts(self) -> tuple[np.ndarray, ...]:
        """All that answers up to the triples have brought; `restored` takes it."""
        return self.counts, self.seen2, self.kept, self.seen3

    def restored(self, facts: bytes, tokens: int, words: int) -> "_Texts":
        counts, seen2, self.kept, seen3 = unpack(facts)
        self.set_ones(counts, tokens, words)
        self.set_twos(seen2)
        self.set_kept()
        self.seen3 = seen3
        self.sure = _sure(self.seen12, seen3 >> 2)
        return self

    def gains2(self) -> tuple[np.ndarray, ...]:
        k = self.k[~self.sure]
        return _divergence(self.context, self.of_context, self.seen3[~self.sure], self.c12[~self.sure], self.p[k], self.train[k], self.of[k])

    def set_gains2(self, answers: np.ndarray, gain: float) -> np.ndarray:
        """Which of the places after two symbols may have their context extended."""
        of = unique(self.contexts(self.k[~self.sure], 2))[1]
        bits = _bits(self.sure, self.seen3 >> 2, self.c12, self.p[self.k], answers[of], gain)
        kept = np.flatnonzero(bits & 1)
        at = self.k[kept]
        self.depth[at] = 2
        self.p[at] = _smoothed(self.seen3[kept] >> 2, self.c12[kept], self.p[at])
        return bits & 2 > 0

    def whole(self, at: np.ndarray, n: int) -> np.ndarray:
        """Which places are after n symbols of their text."""
        return at - n >= self.at[np.searchsorted(self.at, at, "right") - 1]

    def contexts(self, at: np.ndarray, n: int) -> np.ndarray:
        """The n symbols before each place."""
        h = self.symbol[at - n]
        for i in range(1, n):
            h = mix(mix(h) * C1 + self.symbol[at - n + i])
        return h

    def asked(self, level: "_Level", n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams whose counts are not known, where those of each place are among them, and the places."""
        before, after = level.at[level.of < 0], level.at[level.seen < 0]
        keys, of = unique(np.concatenate([self.contexts(before, n), self.contexts(after + 1, n + 1)]))
        return keys, of, np.concatenate([before, after])

    def rows(self, tokens: int) -> dict:
        if not len(self.ids):
            return {}
        per = lambda v: np.add.reduceat(np.where(self.token, v, 0), self.at[:-1])
        return {
            "doc_id": self.ids, "held_out": self.held, "n_tokens": np.diff(self.at) - 1,
            "n_known": per((self.c1 > 0).astype(np.int64)), "train_tokens": np.full(len(self.ids), tokens),
            "base_score": per(np.log10(self.p0)), "score": per(np.log10(self.p)),
            "mean_depth": per(self.depth.astype(float)) / (np.diff(self.at) - 1),
        }


def _smoothed(c: np.ndarray, of: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    return (c + ALPHA * shorter) / (of + ALPHA)


def _gain(c: np.ndarray, of: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Log ratio of the two predictions of one occurrence, itself left out of the counts."""
    return np.log((np.maximum(c - 1, 0) + ALPHA * shorter) / ((of - 1 + ALPHA) * shorter))


def _told(seen: np.ndarray, of: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether `seen`, for the context that is one symbol shorter, holds for the longer one too, by the counts of both."""
    return (seen & ~2 <= 4) | (of == shorter)


def _places(of: np.ndarray, train: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each of n keys in training, and whether others are held out."""
    got = np.bincount(of, weights=train, minlength=n).astype(np.int64)
    return got, (np.bincount(of, minlength=n) > got).astype(np.uint8)


def _divergence(keys, at, seen, of, p, train, symbol) -> tuple[np.ndarray, ...]:
    """The contexts with this batch's part of their divergence and of what longer ones can gain at most if they are
    not, and if they are retained; `at` tells the context of each place, `symbol` what follows it.

    What an n-gram that occurs once gains is told by the count of its context, and it leaves longer ones nothing to gain.  So
    the occurrences in training are counted, and those of such n-grams.  Of any other, all occurrences gain alike and one batch
    sends them all (`_seen`); sums are of those, for contexts that have some here.
    """
    c = seen >> 2
    total = lambda v, i: np.bincount(at[i], weights=v, minlength=len(keys))
    trained = np.flatnonzero(train)
    mine = trained[(c[trained] > 1) & (seen[trained] & 2 > 0)]
    mine = mine[np.unique(at[mine] * (symbol.max(initial=0) + 1) + symbol[mine], return_index=True)[1]]
    some = total(None, mine) > 0
    n, once = total(None, trained), total(None, trained[c[trained] == 1])
    c, of, p = c[mine], of[mine], p[mine]
    most = lambda q: _short(total(c * np.log((c - 1 + ALPHA * q) / ((c - 1 + ALPHA) * q)), mine)[some])
    return keys, n, once, some.astype(np.uint8), total(c * _gain(c, of, p), mine)[some], most(p), most(_smoothed(c, of, p))


def _sure(context: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Places that know what their context gains: it occurs twice, before other symbols each time, which gains nothing;
    or always before the symbol at the place, and in no text held out, where others would have to ask.

    `context` is what `_seen` tells of it.  All places in training agree in this, and of
    those held out each that asks is answered with the nothing that nobody sent.
    """
    return ((context >> 2 == 2) & (c == 1)) | (context & ~2 == 4 * c)


def _bits(sure, c, of, p, answers: np.ndarray, gain: float) -> np.ndarray:
    """Bits of each place's context as of `_kept_or_open`, with the answers for those that asked."""
    bits = np.zeros(len(sure), np.uint8)
    bits[~sure] = answers
    at = np.flatnonzero(sure & (c == of))
    of, p = of[at], p[at]
    most = lambda q: of * np.log((of - 1 + ALPHA * q) / ((of - 1 + ALPHA) * q))
    kept = most(p) > gain  # what it gains is all that a longer one can
    bits[at] = kept + 2 * (np.where(kept, most(_smoothed(of, of, p)), most(p)) > gain - 1e-6).astype(np.uint8)
    return bits


def _short(most: np.ndarray) -> np.ndarray:
    """Values of 0 and above rounded up to the first half of a 32-bit float, under 1 % more."""
    up = np.nextafter(np.maximum(most, 0).astype(np.float32), np.float32(np.inf)).view(np.uint32)
    return ((up + np.uint32(0xFFFF)) >> np.uint32(16)).astype(np.uint16)


def _long(short: np.ndarray) -> np.ndarray:
    return (short.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64)


def _kept_or_open(gain: float):
    """Of contexts: 1 where their divergence exceeds `gain`, and 2 where that of a longer one may."""

    def run(asks: list[list[np.ndarray]]) -> list[tuple]:
        keys, of = unique(np.concatenate([a[0] for a in asks]))
        n, once, has = (np.concatenate([a[i] for a in asks]) for i in (1, 2, 3))
        some = of[has > 0]  # contexts of the sums
        total = lambda v, at: np.bincount(at, weights=v, minlength=len(keys))
        sums = lambda i, read: total(read(np.concatenate([a[i] for a in asks])), some)
        kept = sums(4, np.asarray) + total(once, of) * np.log(ALPHA / (np.maximum(total(n, of), 1) - 1 + ALPHA)) > gain
        most = np.where(kept, sums(6, _long), sums(5, _long))
        bits = kept + 2 * (most > gain - 1e-6).astype(np.uint8)
        return [(part,) for part in np.split(bits[of], np.cumsum([len(a[0]) for a in asks])[:-1])]

    return run


@dataclass(frozen=True)
class _Level:
    """Places after candidate contexts of n symbols, in order, and what is known of them.

    of: what `_seen` tells of the context; seen: the same of the context with its next symbol; -1 is not known.  p: the prediction of the shorter context.  once: places after contexts that no two places have.
    """

    at: np.ndarray
    p: np.ndarray
    of: np.ndarray
    seen: np.ndarray
    once: np.ndarray

    @staticmethod
    def made(at: np.ndarray, p: np.ndarray, of: np.ndarray, shorter: np.ndarray, seen: np.ndarray) -> "_Level":
        """From `of` and what is known of the places for the context that is one symbol shorter."""
        dead = (of >= 0) & (of < 8)
        ok = ~dead
        return _Level(at[ok], p[ok], of[ok], np.where(_told(seen, of >> 2, shorter >> 2), seen, -1)[ok], at[dead])

    @staticmethod
    def read(blob: bytes) -> "_Level":
        at, p, of, seen, once = unpack(blob)
        return _Level(at.astype(np.int64), p, of - 1, seen - 1, once.astype(np.int64))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.at.astype(np.uint64), self.p, self.of + 1, self.seen + 1, self.once.astype(np.uint64)

    def told(self, found: np.ndarray) -> "_Level":
        """With the counts that were asked for; only contexts that occur twice stay candidates."""
        of, seen, n = self.of.copy(), self.seen.copy(), np.count_nonzero(self.of < 0)
        of[of < 0], seen[seen < 0] = found[:n], found[n:]
        ok = of >= 8
        return _Level(self.at[ok], self.p[ok], of[ok], seen[ok], np.sort(np.concatenate([self.once, self.at[~ok]])))

    def sure(self) -> np.ndarray:
        return _sure(self.of, self.seen >> 2)

    def before(self, at: np.ndarray) -> np.ndarray:
        """What is known of the contexts of one symbol more at the given places; -1 where the place before was not looked at."""
        out = np.where(np.isin(at - 1, self.once), 4, -1)
        i = np.minimum(np.searchsorted(self.at, at - 1), max(len(self.at) - 1, 0))
        return np.where(self.at[i] == at - 1, self.seen[i], out) if len(self.at) else out


def _with_state(asked: dict[str, list], batch: int, *arrays: np.ndarray) -> dict[str, list]:
    """What the batch itself needs again goes beside its questions, in bucket -1."""
    return {"bucket": [-1, *asked["bucket"]], "batch": [batch, *asked["batch"]], "blob": [pack(*arrays), *asked["blob"]]}


def _counted(asks: list[list[np.ndarray]]) -> list[tuple]:
    """Corpus count of each symbol; the first answer of a bucket brings its tokens and distinct words."""
    keys, of = unique(np.concatenate([a[0] for a in asks]))
    total = np.bincount(of, weights=np.concatenate([a[1] for a in asks]), minlength=len(keys)).astype(np.int64)
    words = keys != _START
    sums = [np.array([total[words].sum(), (total[words] > 0).sum()])] + [np.zeros(2, np.int64)] * (len(asks) - 1)
    return list(zip(np.split(total[of], np.cumsum([len(a[0]) for a in asks])[:-1]), sums))


def _counts_or_kept(gain: float):
    """Of n-grams what `_seen` tells; of contexts, whether their divergence exceeds `gain` (one byte each)."""

    def run(asks: list[list[np.ndarray]]) -> list[tuple]:
        if asks[0][1].dtype.kind != "f":
            return _seen(asks)
        return [((part > gain).astype(np.uint8),) for (part,) in summed(asks)]

    return run


def _seen(asks: list[list[np.ndarray]]) -> list[tuple]:
    """Four times the count in training, 2 for the first batch that has the n-gram there, and 1 where a text held out has it.

    That batch sends what all its occurrences gain (`_divergence`).
    """
    keys, of = unique(np.concatenate([a[0] for a in asks]))
    here, held = (np.concatenate([a[i] for a in asks]) for i in (1, 2))
    total, held = (np.bincount(of, weights=v, minlength=len(keys)).astype(np.int64) for v in (here, held))
    seen, trained = (4 * total + (held > 0))[of], np.flatnonzero(here)
    first = np.full(len(keys), -1)
    first[of[trained[::-1]]] = trained[::-1]  # the last one written stays
    seen[first[first >= 0]] += 2
    return [(part,) for part in np.split(seen, np.cumsum([len(a[0]) for a in asks])[:-1])]


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        got = [unpack(b)[1] for b in part["blob"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"n": pa.array([int(g[0]) for g in got], pa.int64()),
                                          "v": pa.array([int(g[1]) for g in got], pa.int64())})


def score(docs: DataFrame, folds: int = FOLDS, gain: float = GAIN, depth: int | None = 2) -> DataFrame:
    """Log10 probabilities of all texts by the root alone (base_score) and by the suffix tree (score).

    The model learns from the texts that are not held out.  Contexts have up to `depth` symbols (two at least), any
    number where it is None.
    """
    batches = Batches.write(docs.select("doc_id", "text"), "lm-batches", prepare=_Texts.prepared(folds))
    n = batches.buckets
    # fewer keys go to fewer buckets, as a batch sends a row to each
    half, few = math.ceil(n / 2), math.ceil(n / 4)

    def ask_ones(batch: int, table: pa.Table, _) -> dict:
        return question(batch, half, *_Texts(table).ones())

    symbols = batches.stored(answer(batches.each(ask_ones, ASKED), _counted), "lm-symbols")
    ones = batches.rows(symbols)
    tokens, words = (int(x or 0) for x in ones.select("blob").mapInArrow(_sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first())

    def with_ones(table: pa.Table, got: dict) -> _Texts:
        t = _Texts(table)
        t.set_ones(joined(got[0]), tokens, words)
        return t

    def ask_twos(batch: int, table: pa.Table, got: dict) -> dict:
        t = with_ones(table, got)
        t.pairs()
        return question(batch, n, *t.twos())

    pairs = batches.stored(answer(batches.each(ask_twos, ASKED, ones), _seen), "lm-pairs")
    twos = batches.rows(pairs)

    def with_twos(table: pa.Table, got: dict) -> _Texts:
        t = with_ones(table, got)
        t.pairs()
        t.triples(t.set_twos(joined(got[1])[t.of2]))
        return t

    def ask_threes(batch: int, table: pa.Table, got: dict) -> dict:
        t = with_twos(table, got)
        a, b = question(batch, n, *t.threes()), question(batch, half, *t.gains1())
        b["bucket"] = [x + n for x in b["bucket"]]  # gains have buckets of their own
        return {c: a[c] + b[c] for c in a}

    triples = batches.stored(answer(batches.each(ask_threes, ASKED, ones, twos), _counts_or_kept(gain)), "lm-triples")
    threes = batches.rows(triples)

    def with_threes(table: pa.Table, got: dict) -> _Texts:
        t = with_twos(table, got)
        t.set_gains1(joined({b: x for b, x in got[2].items() if b >= n}, kind="u1"))
        t.set_threes(joined({b: x for b, x in got[2].items() if b < n}))
        return t

    def ask_gains(batch: int, table: pa.Table, got: dict) -> dict:
        t = with_threes(table, got)
        return _with_state(sums(batch, half, *t.gains2()), batch, *t.facts())

    def sums(batch: int, buckets: int, keys: np.ndarray, times: np.ndarray, once: np.ndarray, some: np.ndarray, *more: np.ndarray) -> dict:
        return question(batch, buckets, keys, times, once, some, some=(some > 0, more))

    def with_gains(table: pa.Table, got: dict) -> tuple[_Texts, np.ndarray]:
        t = _Texts(table).restored(got[-1][0], tokens, words)
        return t, t.set_gains2(joined(got[0], kind="u1"), gain)

    def ask_counts(batch: int, t: _Texts, level: _Level, n_symbols: int) -> dict:
        if not len(level.at):
            return {}
        keys, of, at = t.asked(level, n_symbols)
        return _with_state(question(batch, few, keys, *_places(of, t.train[at], len(keys))), batch, *level.arrays())

    def ask_third(batch: int, table: pa.Table, got: dict) -> dict:
        t, more = with_gains(table, got)
        more[more] = t.whole(t.k[more], 3)
        at, seen = t.k[more], np.full(len(t.symbol), 4)
        seen[t.k] = t.seen3
        return ask_counts(batch, t, _Level.made(at, t.p[at], seen[at - 1], t.seen12[more], seen[at]), 3)

    def ask_divergence(n_symbols: int):
        def run(batch: int, table: pa.Table, got: dict) -> dict:
            if got[-1][0] is None:
                return {}
            t, level = _Texts(table), _Level.read(got[-1][0])
            level = level.told(joined(got[0])[t.asked(level, n_symbols)[1]])
            if not len(level.at):
                return {}
            open_ = ~level.sure()
            at = level.at[open_]
            keys, of = unique(t.contexts(at, n_symbols))
            asked = _divergence(keys, of, level.seen[open_], level.of[open_] >> 2, level.p[open_], t.train[at], t.of[at])
            return _with_state(sums(batch, few, *asked), batch, *level.arrays())

        return run

    def decided(t: _Texts, n_symbols: int, state: bytes, answers: dict) -> tuple[_Level, np.ndarray, np.ndarray]:
        """Places after contexts of so many symbols, the predictions of these, and their bits."""
        level = _Level.read(state)
        sure, c, of = level.sure(), level.seen >> 2, level.of >> 2
        got = joined(answers, kind="u1")[unique(t.contexts(level.at[~sure], n_symbols))[1]]
        return level, _smoothed(c, of, level.p), _bits(sure, c, of, level.p, got, gain)

    def next_level(n_symbols: int):
        def run(batch: int, table: pa.Table, got: dict) -> dict:
            if got[-1][0] is None:
                return {}
            t = _Texts(table)
            last, new, bits = decided(t, n_symbols - 1, got[-1][0], got[0])
            more = (bits & 2 > 0) & t.whole(last.at, n_symbols)
            at, p = last.at[more], np.where(bits & 1, new, last.p)[more]
            return ask_counts(batch, t, _Level.made(at, p, last.before(at), last.of[more], last.seen[more]), n_symbols)

        return run

    def answered(found: DataFrame, name: str, run, answers: str, *done: str) -> tuple[str, DataFrame] | None:
        """The folder of the batches' own rows, and the answers to their questions, which are removed; None without any.

        The folders `done` are what `found` was made of, and removed before the questions are answered.
        """
        own, asked = batches.asked(found, name)
        for folder in done:
            folders.remove(batches.spark, folder)
        if not folders.exists(batches.spark, own):
            return None
        if not folders.exists(batches.spark, asked):  # all is known
            return own, batches.spark.createDataFrame([], ASKED)
        got = batches.keep(answer(batches.rows(asked), run), answers)
        folders.remove(batches.spark, asked)
        return own, got

    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double, mean_depth double")
    first = answered(batches.each(ask_gains, ASKED, ones, twos, threes), "lm-facts", _kept_or_open(gain), "lm-gains", symbols, pairs, triples)
    if first is None:  # no documents
        return batches.each(lambda *_: {}, schema)
    facts, gains = batches.own(first[0]), first[1]
    levels, decisions, level = [], [], 3
    found = batches.each(ask_third, ASKED, gains, own=(facts,)) if depth is None or depth >= 3 else None
    while found is not None:
        counted = answered(found, "lm-contexts", _seen, "lm-counts")
        if counted is None:
            break
        found = batches.each(ask_divergence(level), ASKED, counted[1], own=(batches.own(counted[0]),))
        kept = answered(found, "lm-divergence", _kept_or_open(gain), "lm-kept", counted[0])
        if kept is None:
            break
        levels.append(batches.own(kept[0]))
        decisions.append(kept[1])
        level += 1
        found = batches.each(next_level(level), ASKED, kept[1], own=(levels[-1],)) if depth is None or level <= depth else None

    def scored(batch: int, table: pa.Table, got: dict) -> dict:
        t, _ = with_gains(table, got)
        for n_symbols, (state, answers) in enumerate(zip(got[-1][1:], [got[k] for k in range(1, len(got) - 1)]), 3):
            if state is not None:
                level, new, bits = decided(t, n_symbols, state, answers)
                on = bits & 1 > 0
                t.p[level.at[on]], t.depth[level.at[on]] = new[on], n_symbols
        return t.rows(tokens)

    return batches.each(scored, schema, gains, *decisions, own=(facts, *levels))
