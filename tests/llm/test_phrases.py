"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pytest

from tests.llm import cases
from tidefold.llm import phrases


def plain(rows, support, top):
    """(lang, rank, phrase, a, l, r, n, score) by definition."""
    counts, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", cases.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = {p: c for p, c in counts.items() if len(p[1]) > 1 and c >= support}
    longer = Counter()
    for (lang, w), c in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], c)
    out = {}
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] >= 100 * a:
            continue
        cut = min((1000 * a * total[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        k = cut[1]
        out.setdefault(lang, []).append((" ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], total[lang], cut[0]))
    ranked = []
    for lang, rows_ in out.items():
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        ranked += [(lang, i + 1, *r) for i, r in enumerate(rows_[:top])]
    return sorted(ranked)


def corpus(seed, n=120):
    r = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gamma", "ß", "日本", "x y", "to", "of", "the", "the", "the"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randrange(0, 60)):
            words.append(r.choice(vocabulary))
            words.append(r.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " new york city hall "]))
        rows.append((None if i % 17 == 0 else i * 1000, None if i % 23 == 5 else "".join(words), [None, "en", "und", "é"][i % 4], "s"))
    return rows


@pytest.mark.parametrize("support,shards,top", [(10, 16, 2000), (10, 1, 7), (3, 50, 2000), (40, 3, 2000)])
def test_plain(spark, support, shards, top):
    rows = corpus(support)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string").repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(df, support, top, shards).collect())
    want = plain(rows, support, top)
    assert want and got == want


def test_cases(spark):
    rows = cases.documents() * 3
    got = sorted(tuple(r) for r in phrases.collocations(cases.frame(spark, rows), 3, 2000).collect())
    assert got == plain(rows, 3, 2000)


def test_small_bitmap(spark, monkeypatch):
    """Bits that others set only cost time."""
    monkeypatch.setattr(phrases, "BITS", 3)
    rows = corpus(1, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string")
    assert sorted(tuple(r) for r in phrases.collocations(df, 10, 2000).collect()) == plain(rows, 10, 2000)


def test_wide_products(spark):
    """Products beyond 64 bits are exact."""
    rows = [("en", 0, None, 9 * 10**15), ("en", 1, "a", 4 * 10**12 + 7), ("en", 1, "b", 3 * 10**12 + 11), ("en", 2, "a b", 2 * 10**12 + 3)]
    (got,) = phrases.scores(spark.createDataFrame(rows, phrases.PHRASES)).collect()
    assert got.score == 1000 * rows[3][3] * rows[0][3] // (rows[1][3] * rows[2][3])


def test_empty(spark):
    assert phrases.collocations(cases.frame(spark, []), 3).collect() == []
