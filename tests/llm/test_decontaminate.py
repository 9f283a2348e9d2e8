from collections import defaultdict

import pytest

from tests.llm import cases
from tidefold.llm import decontaminate as D

ITEMS = [(1, cases.PASSAGE), (2, "hello there"), (3, None), (4, ""), (5, "a a a a a a a a a a a a"), (6, "ab ab ab ab ab ab ab ab ab ab ab"),
         (7, "!!"), (None, " ".join(cases.B.split()[20:33])), (8, " ".join(cases.B.split()[20:33]).upper()), (1, "hello"),
         (9, "never seen words are in this item for sure and more of them")]


def expected(rows):
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = cases.alnum(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    out = []
    for i, t, *_ in rows:
        w, hit, items = cases.alnum(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(items)))
    return sorted(out, key=str)


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_hits(spark, block_bytes):
    got = D.find_hits(cases.frame(spark), benchmark(spark), block_bytes=block_bytes).collect()
    have = [(r.doc_id, r.n_words, sum(e - s for s, e in zip(r.starts, r.ends)), sorted(r.items)) for r in got]
    assert sorted(have, key=str) == expected(cases.documents())


def test_removal_and_empty_tables(spark):
    docs = cases.frame(spark)
    kept = D.remove_hits(docs, benchmark(spark))
    assert kept.columns == docs.columns
    clean = {str(r[0]) for r in expected(cases.documents()) if not r[2]}
    assert {str(r.doc_id) for r in kept.collect()} == clean
    assert D.remove_hits(docs, benchmark(spark, [])).count() == docs.count()
    assert D.find_hits(cases.frame(spark, []), benchmark(spark)).collect() == []
