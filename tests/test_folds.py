"""Folds and merges against a plain replay, one operation after the other."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidefold.model import DELETE, REPLACE, SET
from tidefold.operators import fold, fold_nested, keyless, merge, scan

OPS = "k string, op string, upsert boolean, doc struct<a:int,b:int,c:int>, present array<string>, ord struct<offset:bigint,sub:int>"
COLUMNS = ["a", "b", "c"]


def random_rows(rng, n, keys, mixed):
    rows = []
    for i in range(n):
        k = f"k{rng.randrange(keys)}"
        op = rng.choices([REPLACE, SET, DELETE], [1, 6, 2] if mixed != "sets" else [0, 6, 2])[0]
        upsert = op == REPLACE or (op == SET and (mixed == "sets" or (mixed == "both" and rng.random() < 0.3)))
        doc = tuple(rng.choice([None, rng.randrange(100)]) for _ in COLUMNS)
        present = None if op != SET else sorted(rng.sample(COLUMNS, rng.randint(1, 3)))
        rows.append((k, op, upsert, None if op == DELETE else doc, present, (i, 0)))
    return rows


def replay(state, rows):
    state = {k: dict(v) for k, v in state.items()}
    for k, op, upsert, doc, present, _ in sorted(rows, key=lambda r: r[5]):
        if op == DELETE:
            state.pop(k, None)
        elif op == REPLACE:
            state[k] = dict(zip(COLUMNS, doc))
        elif k in state or upsert:
            row = state.setdefault(k, dict.fromkeys(COLUMNS))
            row.update({c: v for c, v in zip(COLUMNS, doc) if c in present})
    return state


def as_state(df):
    return {r["k"]: r["doc"].asDict() for r in df.collect()}


@pytest.mark.parametrize("mixed", ["none", "sets", "both"])
@pytest.mark.parametrize("seed", [1, 2])
def test_fold_columns_equals_replay(spark, mixed, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 800, 60, mixed)
    empty = spark.createDataFrame([], "k string, doc struct<a:int,b:int,c:int>")
    flag = mixed == "both"
    first, second = (spark.createDataFrame(part, OPS) for part in (rows[:500], rows[500:]))
    target = merge.merge_columns(empty, fold.fold_columns(first, flag, width=7))
    assert as_state(target) == replay({}, rows[:500])
    merged = merge.merge_columns(target, fold.fold_columns(second, flag, width=7))
    assert as_state(merged) == replay({}, rows)


def test_fold_latest_equals_replay(spark):
    rows = [r for r in random_rows(random.Random(3), 600, 40, "none") if r[1] != SET]
    empty = spark.createDataFrame([], "k string, doc struct<a:int,b:int,c:int>")
    df = spark.createDataFrame(rows, OPS)
    half = F.col("ord.offset") < 300
    target = merge.merge_latest(empty, fold.fold_latest(df.filter(half)))
    assert as_state(merge.merge_latest(target, fold.fold_latest(df.filter(~half)))) == replay({}, rows)


JSON_OPS = "k string, op string, upsert boolean, sets map<string,string>, unsets array<string>, ord struct<offset:bigint,sub:int>"


def random_documents(rng, n, keys, paths):
    rows = []
    for i in range(n):
        op = rng.choices([REPLACE, SET, DELETE], [2, 8, 1])[0]
        picks = rng.sample(paths, rng.randint(1, 2))
        sets, unsets = {}, []
        if op == REPLACE:
            sets = {"_id": "1", "n": str(i)}
        elif op == SET:
            # paths of one patch must not overlap
            if any(a != b and (a.startswith(b + ".") or b.startswith(a + ".")) for a in picks for b in picks):
                picks = picks[:1]
            for p in picks:
                if rng.random() < 0.3:
                    unsets.append(p)
                else:
                    deep = {"x": i, "y": {"z": i}} if p in ("d", "d.p") else i
                    sets[p] = json.dumps(deep)
        rows.append((f"k{rng.randrange(keys)}", op, op == REPLACE, sets, unsets, (i, 0)))
    return rows


def replay_documents(rows):
    docs = {}
    for k, op, _, sets, unsets, _ in sorted(rows, key=lambda r: r[5]):
        if op == DELETE:
            docs.pop(k, None)
            continue
        if op == REPLACE:
            docs[k] = {}
        if k not in docs:
            continue
        for path, text in [*((p, t) for p, t in sets.items()), *((p, None) for p in unsets)]:
            node, (*parents, last) = docs[k], path.split(".")
            for name in parents:
                if name not in node and text is None:
                    node = None
                    break
                node = node.setdefault(name, {})
            if node is None:
                continue
            if text is None:
                node.pop(last, None)
            else:
                node[last] = json.loads(text)
    return docs


def without_empty(doc):
    return {k: w for k, v in doc.items() if (w := without_empty(v) if isinstance(v, dict) else v) != {}}


def test_fold_fields_equals_replay(spark):
    rows = random_documents(random.Random(5), 900, 40, ["a", "b", "c"])
    df = spark.createDataFrame(rows, JSON_OPS)
    empty = spark.createDataFrame([], "k string, doc string")
    half = F.col("ord.offset") < 450
    target = merge.merge_fields(empty, fold.fold_fields(df.filter(half)))
    merged = merge.merge_fields(target, fold.fold_fields(df.filter(~half)))
    assert {r["k"]: json.loads(r["doc"]) for r in merged.collect()} == replay_documents(rows)


@pytest.mark.parametrize("seed", [7, 8])
def test_nested_patches_equal_replay(spark, seed):
    rows = random_documents(random.Random(seed), 900, 30, ["a", "d", "d.p", "d.p.q", "d.v", "e.f"])
    df = spark.createDataFrame(rows, JSON_OPS)
    expected = replay_documents(rows)

    leaves = {}
    for r in fold_nested.fold_paths(df).collect():
        leaves.setdefault(r["k"], {})[r["path"]] = json.loads(r["value"])
    flat = lambda d, at="": {
        q: w for n, v in d.items()
        for q, w in (flat(v, f"{at}{n}.") if isinstance(v, dict) and v else {f"{at}{n}": v}).items()
    }
    assert leaves == {k: flat(without_empty(d)) for k, d in expected.items()}

    half = F.col("ord.offset") < 450
    empty = spark.createDataFrame([], "k string, doc string")
    target = fold_nested.merge_paths(empty, fold_nested.fold_writes(df.filter(half))).drop("err")
    merged = fold_nested.merge_paths(target, fold_nested.fold_writes(df.filter(~half)))
    # a parent both made and emptied by patches of one batch is not reproduced
    got = {r["k"]: without_empty(json.loads(r["doc"])) for r in merged.collect()}
    assert got == {k: without_empty(d) for k, d in expected.items()}


def test_paths_through_scalars_are_reported(spark):
    rows = [("k", REPLACE, True, {"a": "1"}, [], (0, 0)), ("k", SET, False, {"a.b": "2", "c": "3"}, [], (1, 0))]
    empty = spark.createDataFrame([], "k string, doc string")
    got = fold_nested.merge_paths(empty, fold_nested.fold_writes(spark.createDataFrame(rows, JSON_OPS))).first()
    assert json.loads(got["doc"]) == {"a": 1} and got["err"] == fold_nested.SCALAR


def test_numeric_path_parts_are_bad(spark):
    rows = [("k", SET, False, {"a.0.b": "1"}, [], (0, 0)), ("k", SET, False, {"a0.b": "1"}, [], (1, 0))]
    got = fold_nested.check_paths(spark.createDataFrame(rows, JSON_OPS)).orderBy("ord").collect()
    assert [r["err"] for r in got] == ["path addresses an array element", None]


def test_hot_key_reaches_the_shuffle_reduced(spark):
    """A key with a third of the rows: the map side leaves one row per task for it."""
    ops = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(REPLACE).alias("op"), F.struct(F.col("id").alias("v")).alias("doc"), F.col("id").alias("ord"),
    )
    plan = fold.fold_latest(ops)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan
    got = fold.fold_latest(ops).filter("k = 'hot'").first()
    assert got["doc"]["v"] == 89_997


def test_keyless_rows_repeat_and_split(spark):
    images = spark.createDataFrame([("a", 5), ("b", 1), ("c", 0), ("d", -2)], "img string, n bigint")
    got = keyless.rows(images, ["img"], per_row=2).groupBy("img").count().collect()
    assert {r["img"]: r["count"] for r in got} == {"a": 5, "b": 1}
    assert [r["img"] for r in keyless.inconsistent(images).collect()] == ["d"]


def test_number_rows_and_running_max(spark):
    rng = random.Random(11)
    rows = [("t" if rng.random() < 0.7 else "u", o, rng.randrange(1000)) for o in rng.sample(range(3000), 500)]
    df = spark.createDataFrame(rows, "g string, o bigint, v int")
    numbered = {(r["g"], r["o"]): r["rn"] for r in scan.number_rows(df, ["g"], ["o"], width=37).collect()}
    tops = {(r["g"], r["o"]): r["m"] for r in scan.running_max(df, ["g"], "o", "v", "m", width=37).collect()}
    for g in ("t", "u"):
        top = -1
        for i, (_, o, v) in enumerate(sorted(r for r in rows if r[0] == g)):
            top = max(top, v)
            assert numbered[g, o] == i and tops[g, o] == top
