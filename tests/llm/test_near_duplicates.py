import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tidefold.llm import components, pca_tiles, probminhash as M


def weighted(words):
    n = min(5, len(words))
    return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else Counter()


def jaccard(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in both) for i in x if i in y)


def arrays(x):
    keys = sorted(x)
    return np.array([hash(k) & (2**64 - 1) for k in keys], np.uint64), np.array([x[k] for k in keys], float)


def test_similarity_and_estimate():
    r = random.Random(3)
    errors = []
    for _ in range(20):
        x = Counter(r.randrange(60) for _ in range(r.randrange(1, 90)))
        y = Counter({k: v for k, v in x.items() if r.random() < 0.8}) + Counter(r.randrange(60) for _ in range(10))
        (a, u), (b, v) = ((np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], float)) for c in (x, y))
        exact = jaccard(x, y)
        assert M.similarity(a, u, b, v) == pytest.approx(exact)
        s = M.signatures(np.concatenate([a, b]), np.concatenate([u, v]), np.repeat([0, 1], [len(a), len(b)]), 2, 4096)
        errors.append(abs((s[0] == s[1]).mean() - exact))
    assert max(errors) < 0.05


def expected(rows, least=0.8):
    sets = [(i, weighted(cases.alnum(t))) for i, t, *_ in rows]
    group = list(range(len(sets)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and set(x) & set(y) and 2 * len(set(x) & set(y)) > max(len(x), len(y)) and jaccard(x, y) >= least:
                group[root(a)] = root(b)
    out = []
    for k, (i, x) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if root(j) == root(k) and sets[j][0] is not None]
        out.append((i, i if not x else min(ids, default=None)))
    return sorted(out, key=str)


def test_groups(spark):
    rows = cases.documents()
    for k in range(40):  # one large group of near copies, and a chain
        w = cases.words(100, 200).split()
        w[k] = "z" * (k + 3)
        rows.append((100 + k, " ".join(w), *rows[0][2:]))
        rows.append((200 + k, " ".join(cases.words(300, 201).split()[4 * k : 4 * k + 80]), *rows[0][2:]))
    got = sorted(((r.doc_id, r.class_id) for r in M.near_duplicates(cases.frame(spark, rows)).collect()), key=str)
    assert got == expected(rows)
    kept = M.one_of_each(cases.frame(spark, rows))
    assert kept.columns == cases.frame(spark).columns
    assert {str(r.doc_id) for r in kept.collect()} == {str(i) for i, c in got if i == c}


def test_groups_at_the_threshold(spark):
    # edited copies of three texts, many pairs of which are just below or just above the threshold
    r = random.Random(11)
    rows = []
    for k in range(90):
        w = cases.words(110, 300 + k % 3).split()[: r.randrange(90, 110)]
        for _ in range(r.randrange(1, 4)):
            w[r.randrange(len(w))] = "q" * r.randrange(3, 40)
        rows.append((k, " ".join(w), *cases.documents()[0][2:]))
    got = sorted(((x.doc_id, x.class_id) for x in M.near_duplicates(cases.frame(spark, rows)).collect()), key=str)
    assert got == expected(rows) and 5 < len({c for _, c in got}) < 85


def test_bounds_are_no_less():
    r = np.random.default_rng(3)
    for _ in range(200):
        sets = [np.flatnonzero(r.random(40) < r.random()) for _ in range(6)]
        sets = [k if len(k) else np.array([0]) for k in sets]
        counts = [r.integers(1, 4, len(k)) if _ % 2 else np.ones(len(k), int) for k in sets]
        x = np.zeros(40)
        x[sets[0]] = counts[0]
        got = M._bounds(x, counts[0].sum(), np.concatenate(sets[1:]), np.concatenate(counts[1:]), np.repeat(np.arange(5), [len(k) for k in sets[1:]]), 5)
        exact = [M.similarity(sets[0], counts[0], k, c) for k, c in zip(sets[1:], counts[1:])]
        assert (got >= np.array(exact) - 1e-12).all()
        if not _ % 2:
            assert got == pytest.approx(exact)


def test_members_meet_in_one_band(spark):
    r = np.random.default_rng(0)
    base = r.integers(0, 2**32, M.M).astype(np.uint32)
    other = base.copy()
    other[: 3 * M.BAND : M.BAND] += 1  # the first three bands differ
    rows = [(band, 7, k, k % 3, base.tobytes(), 100) for band in range(5) for k in range(30)]
    rows += [(band, 7, 50, 50, other.tobytes(), 100) for band in range(3, 5)]
    df = spark.createDataFrame(rows, "band int, bucket long, class long, component long, signature binary, n_words long")
    got = {(x.band, x["class"]) for x in M._meeting(df).collect()}
    assert got == {(0, k) for k in range(30)} | {(3, k) for k in [*range(30), 50]}


def test_one_row_of_copies(spark):
    text, more = cases.words(30, 5), cases.words(30, 6)
    rows = [(None, text, {"a": k}) for k in range(3)] + [(4, more, {"a": 2}), (4, more, {"a": 1}), (9, more, None), (4, more + " tail", None),
            (7, "", None), (7, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row map<string, int>").repartition(3)
    got = sorted(((x.doc_id, x.text, x.row) for x in M.one_of_each(docs).collect()), key=str)
    assert [(i, r) for i, t, r in got if t == text] == [(None, {"a": 0})] and len(got) == 4
    assert sum(i == 4 for i, _, _ in got) == 1 and sum(i == 7 for i, _, _ in got) == 2


def test_blocks_find_pairs_across_components(spark):
    r = np.random.default_rng(0)
    base = r.integers(0, 2**32, 128).astype(np.uint32)
    rows = [(0, 7, k, k % 3, base.tobytes()) for k in range(30)] + [(0, 7, 99, 99, r.integers(0, 2**32, 128).astype(np.uint32).tobytes())]
    df = spark.createDataFrame(rows, "band int, bucket long, class long, component long, signature binary")
    got = {(x.a, x.b) for x in M._blocks(df, False).collect()}
    assert got == {(a, b) for a in range(30) for b in range(a + 1, 30) if a % 3 != b % 3}
    assert M._blocks(df, True).count() == 2  # three components


def test_forest_finds_the_hub():
    # 0 is near to all others, which are less near to each other
    pairs = [(a, b, 110 if a == 0 else 95) for a in range(20) for b in range(a + 1, 20)]
    a, b, agree = (np.array(x) for x in zip(*pairs))
    assert sorted(b[M._spanning(a, b, agree)]) == list(range(1, 20)) and set(a[M._spanning(a, b, agree)]) == {0}


def test_no_documents(spark):
    assert M.near_duplicates(cases.frame(spark, [])).collect() == []


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(0, k) for k in range(400, 450)] + [(7, 7)]
    group = {}

    def root(k):
        while group.setdefault(k, k) != k:
            k = group[k]
        return k

    for a, b in links:
        x, y = root(a), root(b)
        group[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(x.id, x.component) for x in got} == {(k, root(k)) for k in group}
    label = components.forest(450, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert all(label[k] == root(k) for k in group)


def test_embeddings(spark):
    r = np.random.default_rng(1)
    centre = r.normal(size=(6, 12))
    rows = [(k, (centre[k % 6] + r.normal(scale=0.25, size=12)).tolist(), 0) for k in range(90)]
    rows += [(200 + k, rows[3][1], 1) for k in range(20)]  # copies
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 12, 0), (303, [float("nan")] * 12, 0), (304, [None, *rows[0][1][1:]], 0),
             (305, [float("inf"), *[1.0] * 11], 0), (306, rows[0][1][:5], 0), (307, [x * 1e300 for x in rows[0][1]], 0),
             (308, [x * 1e-300 for x in rows[0][1]], 0), (5, rows[5][1], 3), (None, rows[0][1], 0), (309, [-x for x in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnRenamed("label", "rep")
    ok = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = [(i, (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max())) for i, v in ok]
    near = [[len(a) == len(b) and a @ b >= 0.9 for _, b in unit] for _, a in unit]
    label = [i for i, _ in ok]
    for _ in range(len(ok)):
        label = [min(label[b] for b in range(len(ok)) if b == a or near[a][b]) for a in range(len(ok))]
    want = [(i, sum(near[a]) - 1, label[a]) for a, (i, _) in enumerate(ok)]
    want += [(i, 0, i) for i, v, _ in rows if not any(i == j for j, _ in ok)]
    got = [(x.vec_id, x.n_links, x.component_id) for x in pca_tiles.link(df, tile=16).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pca_tiles.link(df.limit(0)).collect() == []


def test_embeddings_in_rounds(spark):
    r = np.random.default_rng(4)
    centre = r.normal(size=(70, 48))
    vectors = (centre[np.arange(600) % 70] + r.normal(scale=0.3, size=(600, 48))).astype(np.float32)
    rows = [(int(k), v.tolist()) for k, v in enumerate(vectors)] + [(1000 + k, vectors[3].tolist()) for k in range(30)]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    a, b = np.nonzero(unit @ unit.T >= 0.9)
    label = components.forest(len(rows), a, b)
    want = [(i, int((a == n).sum()) - 1, rows[label[n]][0]) for n, (i, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    # some 40 tiles, three in a round
    got = [(x.vec_id, x.n_links, x.component_id) for x in pca_tiles.link(df, tile=16, chunk_bytes=3 * 16 * 48 * 4).collect()]
    assert sorted(got) == sorted(want) and max(n for _, n, _ in want) > 30


def test_tiles_are_not_shuffled_for_each_other(spark):
    import os
    from threading import Event, Thread

    x = np.random.default_rng(4).normal(size=(1200, 64)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    held, over = [], Event()

    def watch():  # files go when the driver collects its garbage
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        while not over.wait(0.05):
            held.append(sum(os.path.getsize(f) for f in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and os.path.exists(f)))

    watcher = Thread(target=watch)
    watcher.start()
    # vectors without near ones: all of some 80 tiles are compared with all
    links = {x.n_links for x in pca_tiles.link(df, tile=16).collect()}
    over.set()
    watcher.join()
    assert links == {0} and max(held) - held[0] < 8 * x.nbytes


def test_pairs_are_cut_by_bytes():
    import pyarrow as pa

    from tidefold.llm.textbytes import slices

    a, b = ["x" * 900, None, "é" * 10, "y" * 5000, ""], ["", "z" * 100, "w", "y" * 5000, None]
    part = pa.RecordBatch.from_pydict({"text_a": pa.array(a), "text_b": pa.array(b)})
    got = list(slices(part, 1200, ("text_a", "text_b")))
    assert [p.num_rows for p in got] == [2, 1, 1, 1] and sum((p["text_a"].to_pylist() for p in got), []) == a
