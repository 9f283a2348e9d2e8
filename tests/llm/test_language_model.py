import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import cases
from tidefold.llm.exchange import Batches, pack, unique, unpack
from tidefold.llm.suffix_tree_lm import ADD, ALPHA, GAIN, _divergence, _seen, score
from tidefold.sinks import folders

S, E = "<start>", "<end>"


def model(rows):
    """Scores by dictionaries."""
    texts = [(i, cases.spaced(t)) for i, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in texts]
    c1, c2, c3 = Counter(), Counter(), Counter()
    lists = [[S, *w, E] for _, w in texts]
    for s, h in zip(lists, held):
        if not h:
            c1.update(s)
            c2.update(zip(s, s[1:]))
            c3.update(zip(s, s[1:], s[2:]))
    n, v = sum(c1.values()) - c1[S], len(set(c1) - {S})
    p0 = lambda w: (c1[w] + ADD) / (n + ADD * (v + 1))
    g1, g2 = defaultdict(float), defaultdict(float)
    for (s, w), c in c2.items():
        g1[s] += c * math.log((c - 1 + ALPHA * p0(w)) / ((c1[s] - 1 + ALPHA) * p0(w)))
    one = {s for s in c1 if c1[s] >= 2 and g1[s] > GAIN}
    p1 = lambda s, w: (c2[s, w] + ALPHA * p0(w)) / (c1[s] + ALPHA) if s in one else p0(w)
    for (r, s, w), c in c3.items():
        g2[r, s] += c * math.log((c - 1 + ALPHA * p1(s, w)) / ((c2[r, s] - 1 + ALPHA) * p1(s, w)))
    two = {k for k in c2 if c2[k] >= 2 and g2[k] > GAIN}

    def p2(r, s, w):
        return (c3[r, s, w] + ALPHA * p1(s, w)) / (c2[r, s] + ALPHA) if (r, s) in two else p1(s, w)

    out = []
    for (i, _), s, h in zip(texts, lists, held):
        p = [p2(s[j - 2] if j > 1 else None, s[j - 1], s[j]) for j in range(1, len(s))]
        out.append((i, h, len(s) - 1, sum(c1[w] > 0 for w in s[1:]), n,
                    sum(math.log10(p0(w)) for w in s[1:]), sum(map(math.log10, p))))
    return out


def test_against_dictionaries(spark):
    rows = cases.documents()
    order = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = sorted((tuple(r)[:7] for r in score(cases.frame(spark)).collect()), key=order)
    want = sorted(model(rows), key=order)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_empty(spark):
    assert score(cases.frame(spark, [])).collect() == []


def deep(rows):
    """Scores and mean depths by dictionaries of contexts of every length, without the bound."""
    lists = [(i, zlib.crc32(str(i).encode()) % 10 == 0, [S, *cases.spaced(t), E]) for i, t in rows]
    whole, after = Counter(), defaultdict(Counter)
    for _, held, s in lists:
        for j in range(1, len(s)) if not held else ():
            whole[s[j]] += 1
            for n in range(1, j + 1):
                after[tuple(s[j - n : j])][s[j]] += 1
    n, v = sum(whole.values()), len(whole)
    kept = set()

    def p(context, w):
        out, depth = (whole[w] + ADD) / (n + ADD * (v + 1)), 0
        for k in range(1, len(context) + 1):
            if context[-k:] in kept:
                c = after[context[-k:]]
                out, depth = (c[w] + ALPHA * out) / (sum(c.values()) + ALPHA), k
        return out, depth

    for context in sorted(after, key=len):
        c = after[context]
        of = sum(c.values())
        if of >= 2:
            q = {w: p(context[1:], w)[0] for w in c}
            if sum(k * math.log((k - 1 + ALPHA * q[w]) / ((of - 1 + ALPHA) * q[w])) for w, k in c.items()) > GAIN:
                kept.add(context)
    out = {}
    for i, _, s in lists:
        got = [p(tuple(s[:j]), s[j]) for j in range(1, len(s))]
        out[i] = (sum(math.log10(x) for x, _ in got), sum(d for _, d in got) / len(got))
    return out, max(map(len, kept))


def test_long_contexts(spark):
    rows = []
    for k in range(120):
        # the word after a shared passage is told by the word before it
        passage = " ".join(f"w{x}" for x in range(5 if k % 2 else 3))
        rows.append((k, f"{'red' if k % 3 else 'blue'} {passage} {'one' if k % 3 else 'two'} {cases.words(3, k % 7)}"))
    rows += [(200, None), (201, "red"), (202, "ab " * 40)]
    want, longest = deep(rows)
    assert longest == 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = score(docs, depth=None).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.score, r.mean_depth) == pytest.approx(want[r.doc_id], rel=1e-9)
    assert max(r.mean_depth for r in got) > 1
    assert any(r.score != pytest.approx(want[r.doc_id][0]) for r in score(docs).collect())


def test_levels_leave_no_questions(spark, tmp_path, monkeypatch):
    # what a level asked and counted is not kept beside its answers
    names = iter(range(1000))
    monkeypatch.setattr("tidefold.llm.exchange.shared_folder", lambda _, name: f"{tmp_path}/{name}-x{next(names)}")
    rows = [(k, f"{'red' if k % 3 else 'blue'} w0 w1 w2 {'one' if k % 3 else 'two'}") for k in range(60)]
    out = score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), depth=4)
    assert not list(tmp_path.glob("lm-contexts-*/**/*.parquet"))
    assert list(tmp_path.glob("lm-divergence-*/own=true/*.parquet")) and not list(tmp_path.glob("lm-divergence-*/own=false"))
    assert out.count() == 60


def test_counts_that_shorter_contexts_tell_are_not_asked(spark, monkeypatch):
    asked, seen = Batches.asked, []

    def noted(self, df, name):
        own, questions = asked(self, df, name)
        seen.append((name, folders.exists(self.spark, questions) and self.rows(questions).count()))
        return own, questions

    monkeypatch.setattr(Batches, "asked", noted)
    rows = [(k, "ab cd ef gh ij kl mn op") for k in range(40)]  # every context occurs as often as its shorter one
    got = score(spark.createDataFrame(rows, "doc_id long, text string"), depth=4).collect()
    want, _ = deep(rows)
    assert {r.doc_id: r.mean_depth for r in got} == pytest.approx({i: min(d, 4) for i, (_, d) in want.items()})
    contexts = [n for name, n in seen if name == "lm-contexts"]
    assert contexts and not any(contexts)


def test_one_batch_sends_what_all_occurrences_gain():
    keys = [np.array(k, np.uint64) for k in ([1, 2, 3], [2, 3], [2, 3, 4])]
    places = [[1, 0, 2], [1, 1], [3, 0, 0]]
    held = [[0, 1, 0], [0, 0], [0, 0, 1]]
    seen = [part for (part,) in _seen([[k, np.array(c), np.array(h)] for k, c, h in zip(keys, places, held)])]
    assert [(s >> 2).tolist() for s in seen] == [[1, 4, 3], [4, 3], [4, 3, 0]]
    assert [(s & 2).tolist() for s in seen] == [[2, 0, 2], [2, 0], [0, 0, 0]]  # the first batch that trains on it
    assert [(s & 1).tolist() for s in seen] == [[0, 1, 0], [1, 0], [1, 0, 1]]

    # a context before 7 (three times, here twice), 8 (once) and 9 (twice, which another batch sends)
    sent = np.array([14, 14, 6, 8])
    of, p = np.full(4, 6), np.array([0.1, 0.1, 0.2, 0.3])
    got = _divergence(keys[0][:1], np.zeros(4, np.int64), sent, of, p, np.ones(4, np.int64), np.array([7, 7, 8, 9]))
    assert [x.tolist() for x in got[1:4]] == [[4], [1], [1]]
    assert got[4].tolist() == pytest.approx([3 * math.log((2 + ALPHA * 0.1) / ((5 + ALPHA) * 0.1))])


def test_answers_are_stored_once(spark, tmp_path, monkeypatch):
    # answers go to the batches once their facts are stored, and are not kept and shuffled again for each level
    names = iter(range(1000))
    monkeypatch.setattr("tidefold.llm.exchange.shared_folder", lambda _, name: f"{tmp_path}/{name}-y{next(names)}")
    rows = [(k, f"{'red' if k % 3 else 'blue'} w0 w1 w2 {'one' if k % 3 else 'two'}") for k in range(60)]
    out = score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), depth=4)
    for name in ("lm-symbols", "lm-pairs", "lm-triples"):
        assert not list(tmp_path.glob(f"{name}-*/**/*.parquet"))
    assert out.count() == 60


def test_arrays_keep_their_values():
    wide = np.array([0, 255, 256, 2**40, -1], np.int64)
    parts = [wide, wide[:1], wide[:3], np.array([3, 3, 2**63], np.uint64), np.zeros(0, np.int64), np.array([0.1, -2.0]), np.array([7, 300], np.uint16)]
    for a, b in zip(parts, unpack(pack(*parts)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    same = np.array([5 << 60, (5 << 60) + 1, 7, 5 << 60, (5 << 60) + 1], np.uint64)  # alike but for the lowest bits
    keys, of = unique(same)
    assert keys.tolist() == sorted(set(same.tolist())) and (keys[of] == same).all()
