import random

import numpy as np
import pytest

from tests.llm import cases
from tidefold.llm import suffix_dedup as S
from tidefold.llm.sentence_spans import dedup_sentences


def expected(rows, length=50):
    number = lambda i: -(2**63) if i is None else i
    first = {}
    texts = [(number(i), (t or "").encode()) for i, t, *_ in rows]
    for i, t in texts:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, t), row in zip(texts, rows):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        out.append((row[0], bytes(b for b, g in zip(t, gone) if not g), sum(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [50, 30])
def test_against_brute_force(spark, length):
    rows = cases.documents()
    got = S.dedup_substrings(cases.frame(spark), length).collect()
    have = sorted(((r.doc_id, bytes(r.kept), sum(e - s for s, e in zip(r.starts, r.ends))) for r in got), key=str)
    assert have == expected(rows, length)
    assert all(a < b for r in got for a, b in zip(r.ends, r.starts[1:]))  # runs are maximal


def test_empty(spark):
    assert S.dedup_substrings(cases.frame(spark, [])).collect() == []


@pytest.mark.parametrize("length,shallow", [(24, 8), (50, 32), (50, 64)])
def test_deep_shallow_sorts(length, shallow):
    r = random.Random(length + shallow)
    base = bytes(r.choice(b"ab") for _ in range(300))
    data = b"".join(base[r.randrange(250):][: r.randrange(20, 90)] for _ in range(200)) + b"z" * length
    starts = np.array([r.randrange(len(data) - length) for _ in range(2500)])
    order, rank = S.deep_shallow(np.frombuffer(data, np.uint8), starts, length, shallow)
    texts = [data[s : s + length] for s in starts]
    assert [texts[i] for i in order] == sorted(texts)
    by = {}
    assert all(by.setdefault(t, k) == k for t, k in zip(texts, rank.tolist())) and len(set(rank.tolist())) == len(by)


def test_blind_trie():
    r = random.Random(0)
    texts = [bytes(r.choice(b"xy") for _ in range(12)) for _ in range(300)]
    trie = S.BlindTrie()
    for i, t in enumerate(texts):
        trie.add(t, i)
    groups = trie.groups()
    assert [texts[g[0]] for g in groups] == sorted(set(texts)) and sorted(i for g in groups for i in g) == list(range(300))


def sentences(text):
    out, at = [], 0
    import re

    for part in re.finditer(r"[^.!?\n\r]+", text or ""):
        bare = part[0].strip(" \t\n\x0b\x0c\r")
        if bare:
            out.append((bare, part.start() + part[0].index(bare)))
    return out


def test_sentence_runs(spark):
    rows = cases.documents()
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0))
    seen, want = set(), []
    for n in order:
        i, text = rows[n][:2]
        s = sentences(text)
        gone = set()
        for k in range(len(s) - 2):
            run = tuple(x for x, _ in s[k : k + 3])
            if run in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(run)
        left, raw = "", text or ""
        edge = [p for _, p in s] + [len(raw)]
        left = raw[: edge[0]] + "".join(raw[edge[k] : edge[k + 1]] for k in range(len(s)) if k not in gone)
        want.append((i, len(s), sorted(gone), left))
    got = [(r.doc_id, r.n_sentences, r.removed, r.text) for r in dedup_sentences(cases.frame(spark)).collect()]
    # which of two rows with one id comes first is open
    once = lambda rows: sorted((r for r in rows if r[0] not in (None, 31)), key=str)
    assert once(got) == once(want)
    assert sorted(len(r[2]) for r in got if r[0] == 31) == sorted(len(r[2]) for r in want if r[0] == 31)
    assert dedup_sentences(cases.frame(spark, [])).collect() == []


@pytest.mark.parametrize("run,words", [(2, 10), (3, 12), (4, 6)])
def test_runs_by_length(spark, run, words):
    pieces = [cases.words(n, 700 + k) for k, n in enumerate((30, 25, 24, 14, 9, 2, 3, 40))]
    rows = [(100 + k, t, *cases.documents()[0][2:]) for k, t in enumerate([
        f"{pieces[0]} {pieces[7]}. {pieces[1]}. {pieces[2]}. {pieces[3]}. {pieces[4]}! {pieces[5]}? {pieces[6]}",
        f"Other {pieces[7]}. {pieces[1]}. {pieces[2]}. {pieces[3]} other.",  # two whole sentences
        f"Odd {pieces[1]}. {pieces[3]}. Even {pieces[5]}. {pieces[4]}", f"{pieces[4]}! {pieces[5]}. Now {pieces[6]}? {pieces[4]}. {pieces[5]}"])]
    rows += [r for r in cases.documents() if r[0] not in (None, 31)]
    seen, want = set(), {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        s = [x for x, _ in sentences(text)]
        n = [len(cases.spaced(x)) for x in s]
        gone = set()
        for k in range(len(s)):
            cut = next((z for z in range(k + 1, len(s) + 1) if sum(n[k:z]) >= words), len(s) + run)
            for z in {k + run, *([cut] if cut - k < run else [])}:
                if z <= len(s):
                    gone |= set(range(k, z)) if tuple(s[k:z]) in seen else set()
                    seen.add(tuple(s[k:z]))
        want[i] = sorted(gone)
    assert run > 2 or want[101] == [1, 2]
    got = dedup_sentences(cases.frame(spark, rows), run, words).collect()
    assert {r.doc_id: r.removed for r in got} == want
    assert dedup_sentences(cases.frame(spark, []), run, words).collect() == []
