"""Refused patches against a replay of one operation after the other."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.test_sink import events, patches, stored


def at_parent(doc, names):
    for name in names:
        if name not in doc:
            return True
        doc = doc[name]
        if not isinstance(doc, dict):
            return False
    return True


def replay(state, log):
    """State after the log and the offsets of refused patches."""
    state, bad = copy.deepcopy(state), set()
    for offset, k, op, body in log:
        if op == "c":
            state[k] = copy.deepcopy(body)
        elif op == "d":
            state.pop(k, None)
        elif k in state:
            doc = copy.deepcopy(state[k])
            writes = {**{p: None for p in body.get("$unset", {})}, **body.get("$set", {})}
            for path in sorted(writes):
                *parents, last = path.split(".")
                if not at_parent(doc, parents):
                    bad.add(offset)
                    break
                at = doc
                for name in parents:
                    if name not in at and path not in body.get("$set", {}):
                        at = {}
                        break
                    at = at.setdefault(name, {})
                if path in body.get("$set", {}):
                    at[last] = copy.deepcopy(writes[path])
                else:
                    at.pop(last, None)
            else:
                state[k] = doc
    return state, bad


def random_log(rng, n, keys):
    names = ["a", "s", "s.x", "s.x.y", "s.z", "t", "t.u", "t.u.v"]
    values = [1, "{x", None, [1], {}, {"x": 1}, {"x": {"y": 2}}, {"u": {"v": 3}}, {"u": 4}]
    log = []
    for i in range(n):
        k, what = rng.randrange(keys), rng.random()
        if what < 0.12:
            log.append((i, k, "c", {"_id": k, "a": i, **{m: rng.choice(values) for m in "st" if rng.random() < 0.6}}))
        elif what < 0.18:
            log.append((i, k, "d", None))
        else:
            # no path beside one of its parents: stores differ in what they make of that
            paths = []
            for p in rng.sample(names, rng.randint(1, 3)):
                if not any(p == q or p.startswith(q + ".") or q.startswith(p + ".") for q in paths):
                    paths.append(p)
            body = {}
            for p in paths:
                act = "$set" if rng.random() < 0.7 else "$unset"
                body.setdefault(act, {})[p] = rng.choice(values) if act == "$set" else True
            log.append((i, k, "u", body))
    return log


def as_record(k, op, body):
    return k, {"op": op, **({"after": json.dumps(body)} if op == "c" else {"patch": json.dumps(body)} if op == "u" else {})}


@pytest.mark.parametrize("seed", range(2))
def test_random_logs(spark, tmp_path, seed):
    log = random_log(random.Random(seed), 240, 9)
    half = 140
    s = patches(spark, tmp_path, "reject")
    state, bad = {}, set()
    for batch, part in enumerate((log[:half], log[half:])):
        s.apply(events(spark, [as_record(k, op, body) for _, k, op, body in part], part[0][0]), batch)
        state, more = replay(state, part)
        bad |= more
        assert stored(s) == {str(k): v for k, v in state.items()}
    rejects = {r["offset"]: r["err"] for r in s.table("docs").rejected().collect()}
    assert bad and set(rejects) == bad and set(rejects.values()) == {"path runs through a scalar"}


def test_chain_of_refusals(spark, tmp_path):
    """Every patch depends on whether the one before it was refused."""
    s = patches(spark, tmp_path, "reject")
    body = [{"$set": {"a": 1, "b.x": 1}} if i % 2 else {"$set": {"b": 1, "a.x": 1}} for i in range(5)]
    log = [(0, 1, "c", {"_id": 1, "a": {}, "b": {}}), *((i + 1, 1, "u", b) for i, b in enumerate(body))]
    s.apply(events(spark, [as_record(k, op, b) for _, k, op, b in log]), 0)
    state, bad = replay({}, log)
    assert stored(s) == {"1": state[1]} and {r["offset"] for r in s.table("docs").rejected().collect()} == bad


def test_refused_patch_leaves_an_older_one(spark, tmp_path):
    s = patches(spark, tmp_path, "reject")
    s.apply(events(spark, [as_record(1, "c", {"_id": 1, "a": 0, "s": 5})]), 0)
    log = [(1, "u", {"$set": {"a": 1}}), (1, "u", {"$set": {"a": 2, "s.x": 1}})]
    s.apply(events(spark, [as_record(*r) for r in log], 1), 1)
    assert stored(s) == {"1": {"_id": 1, "a": 1, "s": 5}}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_pass_python_once(spark):
    """The filters on what the function gives must not run it again, and asking for scalars needs no Python."""
    from tidefold.operators import errors, fold_nested

    target = spark.createDataFrame([("a", '{"n":1.50,"s":{"t":"\u00e9\\n"}}'), ("b", '{"n":2}')], "k string, doc string")
    delta = spark.createDataFrame(
        [("a", [("s.u", "set", "1e400", 1, 1)])], "k string, writes array<struct<path:string,act:string,text:string,nth:int,made:int>>")
    rows = errors.fail_fast(fold_nested.merge_paths(target, delta))
    assert plan_of(rows).count("ArrowEvalPython") == 1
    assert dict(rows.select("k", "doc").collect()) == {"a": '{"n":1.50,"s":{"t":"\u00e9\\n","u":1e400}}', "b": '{"n":2}'}


@pytest.mark.parametrize("text, path, want", [
    ('{"a":{"b":1}}', ["a"], False), ('{"a":{"b":1}}', ["a", "b"], True), ('{"a":{"b":null}}', ["a", "b"], True),
    ('{"a":{"b":[{}]}}', ["a", "b"], True), ('{"a":1}', ["a", "b"], False), ('{"a":1}', ["c"], False),
    ("5", [], True), ("null", [], True), ("{}", [], False), (None, ["a"], False), ('{"a.b":1}', ["a.b"], True),
])
def test_scalars_are_found_without_python(spark, text, path, want):
    from tidefold.operators.refuse import holds_scalar

    df = spark.createDataFrame([(text, path)], "t string, p array<string>").select(holds_scalar(F.col("t"), F.col("p")).alias("is"))
    assert "EvalPython" not in plan_of(df)
    assert df.first()["is"] is want


@pytest.mark.parametrize("most, batch", [(100_000, 3), (20, 7), (0, 10_000)])
def test_keys_in_one_pass_and_in_rounds(spark, tmp_path, monkeypatch, most, batch):
    """Short keys are settled by a pass over their events, whatever the batches; keys of over `KEY_EVENTS` in rounds."""
    from tidefold.operators import refuse

    monkeypatch.setattr(refuse, "KEY_EVENTS", most)
    rounds = []
    monkeypatch.setattr(refuse, "_in_rounds", lambda df, run=refuse._in_rounds: rounds.append(1) or run(df))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rng = random.Random(7)
        log = random_log(rng, 200, 12)
        log = [(i, k if k < 11 or rng.random() < 0.3 else 0, op, body and {**body, "_id": 0} if k == 11 and op == "c" else body) for i, k, op, body in log]
        log = [(i, k, op, {**body, "_id": k} if op == "c" else body) for i, k, op, body in log]
        s = patches(spark, tmp_path, "reject")
        state, bad = {}, set()
        for n, part in enumerate((log[:110], log[110:])):
            s.apply(events(spark, [as_record(k, op, body) for _, k, op, body in part], part[0][0]), n)
            state, more = replay(state, part)
            bad |= more
        assert stored(s) == {str(k): v for k, v in state.items()}
        assert bad and {r["offset"] for r in s.table("docs").rejected().collect()} == bad
        assert bool(rounds) == (most < 100_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_whole_documents_pass_beside_python(spark):
    """A replacement with plain fields is written in the JVM, as Python would write it; others go through Python."""
    from tidefold.operators import fold_nested

    def writes(*fields, act="replace", later=()):
        first = [("", act, None, 1, None), *((path, "set", text, 1, 1) for path, text in sorted(fields))]
        return [*first, *((path, "set", text, 2, 2) for path, text in later)]

    rows = {
        "plain": writes(("_id", "1"), ("b c", '"é x"'), ("n", "-1.50E+3"), ("z", "null"), ("t", "true")), "none": writes(),
        "escape": writes(("a", r'"x\ny"')), "nested": writes(("a", '{"y":1, "x":[1.0]}')), "dots": writes(("a.b", "1")),
        "name": writes(('q"', "1")), "line": writes(("a\n", "1")), "later": writes(("a", "1"), later=[("a", "2"), ("b.c", "3")]), "gone": writes(act="delete"),
    }
    kind = "array<struct<path:string,act:string,text:string,nth:int,made:int>>"
    delta = spark.createDataFrame(list(rows.items()), f"k string, writes {kind}")
    target = spark.createDataFrame([(k, '{"old":1}') for k in rows], "k string, doc string")
    got = {r["k"]: r["doc"] for r in fold_nested.merge_paths(target, delta).collect()}
    named = {k: [dict(zip(("path", "act", "text", "nth", "made"), w)) for w in v] for k, v in rows.items()}
    assert got == {k: fold_nested._applied('{"old":1}', v)[0] for k, v in named.items() if k != "gone"}
    beside = {r["k"] for r in delta.filter(fold_nested.whole_document(F.col("writes")).isNotNull()).collect()}
    assert beside == {"plain", "none"}


def test_documents_are_judged_once(spark, tmp_path, monkeypatch):
    """What is rejected and what is applied comes of one stored parse of the texts, also when a batch repeats records."""
    from tidefold.plans.target_plan import TargetPlan

    judged = []
    monkeypatch.setattr(TargetPlan, "judged", lambda self, log, run=TargetPlan.judged: judged.append(1) or run(self, log))
    s = patches(spark, tmp_path, "reject")
    log = [(1, "c", {"_id": 1, "a": 0}), (2, "u", {"$set": {"a.0": 1}}), (1, "u", {"$set": {"a": 1}})]
    s.apply(events(spark, [as_record(*r) for r in log]), 0)
    s.apply(events(spark, [as_record(*r) for r in [*log, (1, "u", {"$set": {"b": 2}})]]), 1)
    assert stored(s) == {"1": {"_id": 1, "a": 1, "b": 2}} and len(judged) == 2
    assert {(r["offset"], r["err"]) for r in s.table("docs").rejected().collect()} == {(1, "path addresses an array element")}
