"""Hard negatives against all products."""

import math
import random
from itertools import product

import numpy as np
import pytest

from tidefold.llm import hard_negatives as hn


def plain(rows, every=100, positives=5, negatives=10):
    fine = []
    for i, (vec_id, v, label, *_) in enumerate(rows):
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, vec_id, label, q in fine:
        if vec_id % every:
            continue
        others = [(-sum(a * b for a, b in zip(q, p)), j, same == label) for k, j, same, p in fine if k != i and len(p) == len(q)]
        others.sort()
        for s, j, _ in [o for o in others if o[2]][:positives]:
            window = [o for o in others if not o[2] and 30 * -s <= 100 * -o[0] <= 90 * -s][:negatives]
            out += [(vec_id, j, n + 1, o[1], -s, -o[0]) for n, o in enumerate(window)]
    return sorted(out)


def vectors(seed, n, size, clusters=6, labels=3, noise=0.4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, size))
    x = centres[r.integers(0, clusters, n)] + noise * r.normal(size=(n, size))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    return [(i, [float(v) for v in row], int(r.integers(0, labels)), "e") for i, row in enumerate(x)]


SCHEMA = "vec_id long, embedding array<float>, label int, block string"


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df, **more).collect())


def test_curve():
    """Neighbours on the curve are neighbours in space, and every cell is met once."""
    for n, bits in ((2, 3), (3, 2), (5, 1), (1, 4)):
        cells = np.array(list(product(range(1 << bits), repeat=n)))
        at = hn.hilbert(cells, bits)
        assert sorted(at.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(at)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("values,group", [(64, 2), (1 << 16, 16)])
def test_all_products(spark, values, group, monkeypatch):
    """Blocks of four vectors in small groups, and blocks of all."""
    for name, value in (("VALUES", values), ("ANCHORS", values), ("BLOCKS", group), ("TILES", group), ("ZONES", 3 * group)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(1, 400, 16)
    want = plain(rows, 20)
    assert want and mined(spark, rows, anchors_every=20) == want


def test_blocks_are_left_out(spark, monkeypatch):
    """Zone maps rule blocks out where vectors are clustered."""
    monkeypatch.setattr(hn, "VALUES", 256)
    df = spark.createDataFrame([(i, [float(x) * 10 for x in v], j, "e") for i, v, j, _ in vectors(2, 1200, 8, 8, 2, 0.1)], SCHEMA)
    index = hn.Index(df, 60)
    hn_asks = index.anchors().selectExpr("tile", "nth", "0 AS ask", f"{-hn.FAR} AS low", f"{hn.FAR} AS high")
    index.first(hn_asks, True, 5)
    needs = spark.read.parquet(f"{index.folder}/needs-True-False").collect()
    asked = sum(int(np.unpackbits(np.frombuffer(r.who, np.uint8)).sum()) for r in needs)
    assert asked < 0.5 * index.blocks.count() * 20


def test_cases(spark):
    r = random.Random(3)
    rows = vectors(4, 150, 6)
    rows += [(i, rows[0][1], 1, "e") for i in range(200, 240)]  # ties
    rows += [(100, rows[0][1], 1, "e"), (100, rows[0][1], 1, "e"), (None, rows[1][1], 1, "e"), (300, None, 1, "e"), (301, rows[1][1], None, "e"),
             (400, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 1, "e"), (500, [float("inf")] * 6, 1, "e"), (600, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, "e"),
             (700, [0.0] * 6, 1, "e"), (-100, rows[5][1], 0, "e"), (800, [], 1, "e"), (801, [], 1, "e"), (802, [], 2, "e"),
             (900, [1.0, 2.0], 1, "e"), (901, [3.0, 2.0], 1, "e"), (902, [0.5, 1.0], 2, "e"), (1000, [7.0], 9, "e")]
    rows += [(2000 + i, [r.choice([-1.0, 0.0, 1.0]) for _ in range(6)], i % 2, "e") for i in range(60)]
    want = plain(rows)
    assert want and mined(spark, rows) == want


def test_wide(spark):
    """Products beyond the whole numbers of doubles are exact; those that no long holds are an error."""
    rows = [(i, [float(2**19 + 3 * i), float(2**18 - i)], i % 2, "e") for i in range(0, 40)]
    assert mined(spark, rows, anchors_every=10) == plain(rows, 10)
    with pytest.raises(Exception, match="no long"):
        mined(spark, [(i, [1e30, 1.0], 0, "e") for i in range(3)])


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1, "e")]) == [] and mined(spark, [(100, [1.0], 1, "e")]) == []


def test_relabelled(spark):
    df = hn.relabelled(spark.createDataFrame([(7, 9), (8, 9), (14, None), (None, 3)], "vec_id long, label int"))
    assert [tuple(r) for r in df.collect()] == [(7, 0), (8, 9), (14, None), (None, 3)]
