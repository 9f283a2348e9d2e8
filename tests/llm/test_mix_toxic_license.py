import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm import cases
from tidefold.llm import entropy_mix, license_scan, toxic_chain


def shares(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(k % 3 + 1) for k, s in enumerate(order)}
    total, closed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in closed]
        rest = total - sum(closed.values())
        target = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s: 3.0 * sizes[s] for s in open_ if target[s] >= 3 * sizes[s]}
        if not over:
            return closed | target
        closed |= over
        if len(closed) == len(order):
            return closed


def test_clashing_columns(spark):
    docs = cases.frame(spark)
    with pytest.raises(ValueError):
        entropy_mix.mix(docs)
    got = entropy_mix.mix(docs, name="taken").select("doc_id", "taken.*").collect()
    whole = entropy_mix.take(docs)
    assert whole.columns == docs.columns and len(got) == len(cases.documents())
    assert whole.count() == sum(r.copies for r in got)


def test_mix_reaches_targets(spark):
    rows = [(k, cases.words(5 + (k * 7) % 60, k), "en", [None, "a", "b", "é"][k % 4 if k % 3 else 1], k) for k in range(300)]
    rows += [(900, None, "en", "a", 1), (901, "", None, "zero", 1), (902, cases.words(40, 1), "en", "b", 1), (902, cases.words(40, 1), "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long").repartition(3)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(cases.spaced(r[1]))
    want = shares(dict(sizes))
    got = entropy_mix.mix(docs).select("doc_id", "source", "mix.*").collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 12  # words
    again = entropy_mix.mix(docs.repartition(5)).select("doc_id", "source", "mix.*").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    whole = entropy_mix.take(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r.copies for r in got)


@pytest.mark.parametrize("ids", [[None], [7], [None, 3]])
def test_rows_alike_meet_targets(spark, ids):
    rows = [(ids[k % len(ids)], "ten words " * 5, "a", k) for k in range(900)] + [(5000 + k, cases.words(10, k), "b", k) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, ties int").repartition(4)
    got = entropy_mix.mix(docs).select("doc_id", "source", "mix.*").collect()
    for s, target in shares({"a": 9000, "b": 1500}).items():
        mine = [r for r in got if r.source == s]
        assert len(mine) == (900 if s == "a" else 150) and mine[0].target == pytest.approx(target)
        assert abs(sum(r.copies * r.size for r in mine) - target) <= 10
    again = entropy_mix.mix(docs.repartition(2)).select("doc_id", "source", "mix.*").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert entropy_mix.take(docs).count() == sum(r.copies for r in got)


def test_base_rates_tilt(spark):
    rows = [(k, cases.words(20, k), "en", "ab"[k % 2], k) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    better = F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(0.5)
    got = entropy_mix.mix(docs, weights=(1.0, 1.5), base=better).select("doc_id", "source", "mix.*").collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= 20


def test_mix_of_nothing(spark):
    docs = cases.frame(spark, [])
    assert entropy_mix.take(docs).collect() == []


def test_alignment_is_a_rising_match():
    r = random.Random(2)
    for _ in range(1500):
        a, b = ([r.randrange(7) for _ in range(r.randrange(14))] for _ in range(2))
        got = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    words = list(range(30))
    assert license_scan.align([99, *words[:10], 98, *words[12:], 97], words) == [(i + 1, i) for i in range(10)] + [(i, i) for i in range(12, 30)]


def longest_rise(v):
    best = [1] * len(v)
    for i in range(len(v)):
        best[i] += max((best[j] for j in range(i) if v[j] < v[i]), default=0)
    return max(best, default=0)


def test_patience_finds_the_longest_rise():
    r = random.Random(4)
    for _ in range(300):
        v = r.sample(range(40), r.randrange(12))
        got = license_scan._rising(list(enumerate(v)))
        assert len(got) == longest_rise(v) and all(x[1] < y[1] for x, y in zip(got, got[1:]))


def test_licenses(spark):
    got = {r.doc_id: r for r in license_scan.scan(cases.frame(spark)).collect() if r.license}
    assert {k: v.license for k, v in got.items()} == {33: "Apache-2.0-line", 34: "MIT-line"}
    assert got[33].coverage == 1.0 and (got[33].first_word, got[33].end_word) == (0, 8)
    apache = license_scan.TEMPLATES["Apache-2.0"].split()
    del apache[12], apache[20]
    apache.insert(5, "odd")
    text = f"{cases.A} {' '.join(apache)} {cases.B} Released under the MIT License."
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "doc_id long, text string, license string")
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert rows[1].license == "Apache-2.0" and 0.85 < rows[1].coverage < 1 and "MIT-line" in rows[1].licenses
    assert rows[2].license is None and rows[2].licenses == []
    assert license_scan.scan(cases.frame(spark, [])).collect() == []


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/labels.parquet")
    chain = toxic_chain.train(docs, labels.filter("doc_id % 3 <> 0"))
    scored = toxic_chain.predict(docs, chain).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    right = [(r.p_toxic >= toxic_chain.REJECT) == (r.toxic == 1) for r in scored]
    assert len(right) > 100 and sum(right) / len(right) > 0.93
    assert not [r for r in scored if r.toxic == 0 and r.p_toxic >= toxic_chain.REJECT]


def test_chain_uses_earlier_categories():
    r = np.random.default_rng(0)
    x = r.normal(size=(800, 3))
    first = (x[:, 0] + r.normal(scale=0.1, size=800) > 0).astype(float)
    second = (x[:, 1] + 2 * first - 1 + r.normal(scale=0.1, size=800) > 0).astype(float)
    chain = toxic_chain.Chain.fit(["a", "b"], np.zeros(0, np.uint64), x, np.stack([first, second], 1), np.arange(800) % 5)
    p = chain.predict(x)
    right = ((p[:, 1] > 0.5) == (second > 0)).mean()
    alone = ((toxic_chain.Linear.fit(x, second).logit(x) > 0) == (second > 0)).mean()
    assert ((p[:, 0] > 0.5) == (first > 0)).mean() > 0.95 and right > 0.93 and right > alone + 0.02
    assert len(chain.models[1].weight) == 4 and chain.models[1].weight[3] > 0


def test_toxicity_awkward_cases(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(10, 1, 0, "x"), (10, None, 0, "x"), (29, 0, 1, "x"), (17, 1, 0, "x"), (None, 1, 1, "x"), (14, 1, None, "x"), (31, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    chain = toxic_chain.train(docs, labels)
    got = toxic_chain.predict(docs, chain)
    assert got.count() == docs.count() and got.filter("p_toxic is null or isnan(p_toxic)").count() == 0
    kept = toxic_chain.without(docs, chain)
    assert kept.columns == docs.columns
    none = toxic_chain.train(docs, labels.limit(0))
    assert toxic_chain.without(docs, none).count() == docs.count()
    assert toxic_chain.predict(cases.frame(spark, []), chain).collect() == []


def test_toxic_labels_beside_null_quality(spark):
    r = random.Random(6)
    texts = [(k, cases.words(20, 700 + k) + (" " + r.choice(["grobfoul", "vilewort"]) if k % 2 else "")) for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(k, None if k % 2 else k % 4 // 2, k % 2) for k in range(200)], "doc_id long, quality int, toxic int")
    chain = toxic_chain.train(docs, labels)
    assert sorted(x.doc_id for x in toxic_chain.without(docs, chain).collect()) == list(range(0, 200, 2))


def licenses(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return {r.doc_id: r for r in license_scan.scan(docs).collect()}


def test_licenses_are_told_from_their_kin(spark):
    gpl = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public "
           "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    want = {
        "Released under the BSD License.": ["BSD-line"], "Released under the MIT License.": ["MIT-line"],
        "Released under the Foo License.": [], "Licensed under CC BY-SA 4.0": ["CC-BY-SA-4.0"],
        "Licensed under CC BY 4.0": ["CC-BY-4.0"], "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        "Licensed under CC BY-NC-SA 3.0.": ["CC-BY-NC-SA-3.0"], "Licensed under CC BY-NC 9.0.": [],
        "This work is licensed under the GNU General Public License, version 2.": ["GPL-2.0-line"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0-line"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["AGPL-3.0-line"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": ["CC-BY-SA-3.0"],
        gpl.format("", "2"): ["GPL-2.0"], gpl.format("", "3"): ["GPL-3.0"], gpl.format("Lesser ", "2.1"): ["LGPL-2.1"],
        gpl.format("", "4"): [],
        "Licensed under the Apache License, Version 1.1.": [],
    }
    for name in ("MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD"):
        text = license_scan.TEMPLATES[name]
        want[(text if isinstance(text, str) else text[-1]).replace("{", "").replace("}", "")] = [name]
    got = licenses(spark, [f"{cases.words(20, k)} {t} {cases.words(20, k + 500)}" for k, t in enumerate(want)])
    assert {t: got[k].licenses for k, t in enumerate(want)} == want


def test_every_template_finds_itself(spark):
    texts = [(n, t) for n, v in license_scan.TEMPLATES.items() for t in ([v] if isinstance(v, str) else v)]
    got = licenses(spark, [f"{cases.words(30, k)} {t} {cases.words(30, k + 500)}" for k, (_, t) in enumerate(texts)])
    assert [(got[k].license, got[k].licenses) for k in range(len(texts))] == [(n, [n]) for n, _ in texts]


def test_licenses_in_a_row(spark):
    line, mit = "Released under the MIT License.", license_scan.TEMPLATES["MIT"][0]
    bare = "Published under the MIT License"
    texts = [f"{cases.words(30, k)} {t} {cases.words(30, k + 500)}" for k, t in enumerate([
        f"{line} {line}", " ".join([line] * 100), f"{line} of a and b {line}", f"{mit} {mit}", " ".join([mit] * 100),
        f"{bare} {bare} {bare}", " ".join([line, mit] * 3)])]
    got = licenses(spark, texts)
    assert [got[k].licenses for k in range(7)] == [["MIT-line"]] * 3 + [["MIT"]] * 2 + [["MIT-line"], ["MIT", "MIT-line"]]
    assert [(got[k].coverage, got[k].first_word, got[k].end_word) for k in range(6)] == [
        *[(1.0, 30, 35)] * 3, *[(1.0, 30, 30 + len(cases.alnum(mit)))] * 2, (0.8, 31, 35)]
