"""The configured sink over all write models, against a plain replay."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F, types as T

from tidefold.model import log_schema
from tidefold.plans.settings import Settings
from tidefold.sources import changelog, decode as dec
from tidefold.streaming.sink import ConfiguredSink


def text_log(spark, records):
    rows = [(t, 0, i, None, None, k and json.dumps(k), v and json.dumps(v)) for i, (t, k, v) in enumerate(records)]
    return spark.createDataFrame(rows, log_schema("string", "string"))


def sink(spark, path, values, **kw):
    return ConfiguredSink(
        spark, Settings(values), str(path), buckets=2,
        key_decoder=dec.JsonPlain(T.StructType.fromDDL("id int")),
        value_decoder=dec.JsonPlain(T.StructType.fromDDL("id int, name string, age int")), **kw,
    )


A = [("people", {"id": 1}, {"id": 1, "name": "a", "age": 10}), ("people", {"id": 2}, {"id": 2, "name": "b", "age": 20})]
B = [("people", {"id": 1}, {"id": 1, "name": "c", "age": 11}), ("people", {"id": 2}, None),
     ("people", {"id": 3}, {"id": 3, "name": "d", "age": 30}), ("people", None, None)]


def apply_both(spark, s):
    log = text_log(spark, A + B)
    s.apply(log.filter("offset < 2"), 0)
    first = {r["k"] if isinstance(r["k"], str) else tuple(r["k"]): r for r in s.table("people").read().collect()}
    s.apply(log, 1)
    second = {r["k"] if isinstance(r["k"], str) else tuple(r["k"]): r for r in s.table("people").read().collect()}
    return first, second


def test_replace_and_delete_on_null(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key", "delete.on.null": "true"})
    _, rows = apply_both(spark, s)
    assert {k: (r["doc"]["name"], r["doc"]["age"]) for k, r in rows.items()} == {'{"id":1}': ("c", 11), '{"id":3}': ("d", 30)}


def test_business_key_keeps_its_id(spark, tmp_path):
    values = {
        "id.strategy": "business", "write.model": "business_key", "processors": "id,value.projection",
        "value.projection.type": "blacklist", "value.projection.list": "id",
    }
    from tidefold.plans.target_plan import Registry

    named = lambda df: (F.when(F.col("value").isNotNull(), F.struct(F.col("value.id").alias("person"))), [])
    first, second = apply_both(spark, sink(spark, tmp_path, values, registry=Registry(id_strategies={"business": named})))
    assert set(second) == {(1,), (2,), (3,)} and second[(1,)]["doc"]["name"] == "c"
    assert second[(1,)]["_id"] == first[(1,)]["_id"] != second[(3,)]["_id"]
    assert "_id" not in second[(1,)]["doc"].asDict()


def test_timestamps(spark, tmp_path):
    values = {"id.strategy": "full_key", "write.model": "timestamps"}
    at = lambda ms: F.timestamp_millis(F.lit(ms))
    log = text_log(spark, A + B)
    sink(spark, tmp_path, values, now=at(1000)).apply(log.filter("offset < 2"), 0)
    s = sink(spark, tmp_path, values, now=at(2000))
    s.apply(log, 1)
    rows = s.table("people").read().select(
        "k", F.unix_millis("doc._insertedTS").alias("i"), F.unix_millis("doc._modifiedTS").alias("m"), "doc.name"
    ).collect()
    assert {r["k"]: (r["name"], r["i"], r["m"]) for r in rows} == {
        '{"id":1}': ("c", 1000, 2000), '{"id":2}': ("b", 1000, 1000), '{"id":3}': ("d", 2000, 2000),
    }


def test_rows_with_their_keys(spark, tmp_path):
    values = {"write.model": "row_upsert_timestamp", "delete.on.null": "true", "id.strategy": "full_key"}
    s = sink(spark, tmp_path, values, kind="row", row_keys={"people": ["id"]}, now=F.timestamp_millis(F.lit(5)))
    _, rows = apply_both(spark, s)
    assert {k: (r["doc"]["name"], r["doc"]["modified_ms"]) for k, r in rows.items()} == {(1,): ("c", 5), (3,): ("d", 5)}


def test_stream_into_routed_targets(spark, tmp_path):
    values = {"id.strategy": "full_key", "route.people": "persons", "topic.rewrite": '[{"regex": "x\\\\.(.*)", "replacement": "$1"}]'}
    s = sink(spark, tmp_path / "tables", values)
    log = text_log(spark, A + [("x.people", {"id": 7}, {"id": 7, "name": "x", "age": 1}), ("pets", {"id": 1}, {"id": 1, "name": "p", "age": 2})])
    log.write.parquet(str(tmp_path / "log"))
    stream = changelog.stream_log(spark, "parquet", str(tmp_path / "log"), log.schema)
    s.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    assert s.table("persons").read().count() == 3 and s.table("pets").read().count() == 1


def patches(spark, path, mode="failfast"):
    settings = Settings({"cdc.handler.docs": "document", "on.error": mode})
    return ConfiguredSink(
        spark, settings, str(path), buckets=2, key_decoder=dec.JsonPlain(T.StructType.fromDDL("id string")),
        value_decoder=dec.JsonPlain(T.StructType.fromDDL("op string, after string, patch string")),
    )


def events(spark, records, start=0):
    rows = [("docs", 0, start + i, None, None, json.dumps({"id": json.dumps(k)}), json.dumps(v)) for i, (k, v) in enumerate(records)]
    return spark.createDataFrame(rows, log_schema("string", "string"))


def patch(k, **ops):
    return k, {"op": "u", "patch": json.dumps({f"${n}": v for n, v in ops.items()})}


def stored(sink_):
    return {r["k"]: json.loads(r["doc"]) for r in sink_.table("docs").read().collect()}


DOC = {"_id": 1, "d": {"v": 1, "w": 2}, "s": "x", "n": 12345678901234567.89}


def test_patches_address_nested_fields(spark, tmp_path):
    s = patches(spark, tmp_path)
    s.apply(events(spark, [(1, {"op": "c", "after": '{"_id":1,"d":{"v":1,"w":2},"big":12345678901234567.89,"id":9007199254740993}'})]), 0)
    s.apply(events(spark, [patch(1, set={"d.v": 9, "e.f": [1]}), patch(1, unset={"d.w": True}), patch(2, set={"d.v": 1})], 1), 1)
    rows = s.table("docs").read().collect()
    assert [r["k"] for r in rows] == ["1"]
    assert json.loads(rows[0]["doc"]) == {"_id": 1, "d": {"v": 9}, "e": {"f": [1]}, "big": 12345678901234567.89, "id": 9007199254740993}
    assert '"big":12345678901234567.89' in rows[0]["doc"]


def test_rejects_are_kept(spark, tmp_path):
    s = patches(spark, tmp_path, "reject")
    log = events(spark, [
        (1, {"op": "c", "after": json.dumps(DOC)}), (2, {"op": "c", "after": "no JSON"}), patch(1, set={"d.0": 1}),
        patch(1, set={"s.t": 1, "u": 2}), patch(1, set={"d.v": 5}),
    ])
    s.apply(log.filter("offset = 0"), 0)
    s.apply(log, 1)
    assert stored(s)["1"]["d"] == {"v": 5, "w": 2} and "u" not in stored(s)["1"]  # a patch applies whole or not at all
    bad = {(r["offset"], r["err"]): r for r in s.table("docs").rejected().collect()}
    assert {e for _, e in bad} == {"after is no JSON object", "path addresses an array element", "path runs through a scalar"}
    assert json.loads(bad[1, "after is no JSON object"]["value"])["after"] == "no JSON"
    s.apply(log, 1)  # a batch that is tried again adds nothing
    assert s.table("docs").rejected().count() == len(bad)


def test_bad_patch_stops_the_job(spark, tmp_path):
    s = patches(spark, tmp_path)
    s.apply(events(spark, [(1, {"op": "c", "after": json.dumps(DOC)})]), 0)
    with pytest.raises(Exception, match="path runs through a scalar"):
        s.apply(events(spark, [patch(1, set={"s.t": 1})], 1), 1)


def test_targets_read_their_own_records(spark, tmp_path, monkeypatch):
    from tidefold.streaming import sink as module

    plans, apply_targets = [], module.apply_targets

    def seen(tables, log, *rest):
        plans.extend(log.filter(log["target"] == t)._jdf.queryExecution().executedPlan().toString() for t in tables)
        apply_targets(tables, log, *rest)

    monkeypatch.setattr(module, "apply_targets", seen)
    topics = [f"topic{i}" for i in range(6)]
    log = text_log(spark, [(t, {"id": i}, {"id": i, "name": t, "age": i}) for i in range(3) for t in topics])
    s = sink(spark, tmp_path, {"id.strategy": "full_key"})
    s.apply(log, 0)
    assert len(plans) == 6 and all("PartitionFilters: [isnotnull(target" in p and "InMemoryTableScan" not in p for p in plans)
    for t in topics:
        assert sorted((r["doc"]["id"], r["doc"]["name"], r["doc"]["age"]) for r in s.table(t).read().collect()) == [(i, t, i) for i in range(3)]
    s.apply(log.limit(0), 1)


def test_a_failing_target_leaves_the_others(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key"})
    good = [("people", {"id": 1}, {"id": 1, "name": "a", "age": 1})]
    log = text_log(spark, good).unionByName(text_log(spark, good).withColumns({"topic": F.lit("broken"), "value": F.lit("{")}))
    with pytest.raises(Exception):
        s.apply(log, 0)
    assert s.table("people").read().count() == 1 and s.table("broken").read() is None
    s.apply(log.filter("topic = 'people'"), 0)
    assert s.table("people").read().count() == 1


def test_bucket_count_is_checked(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key"})
    s.apply(text_log(spark, A), 0)
    table = s.table("people")
    with pytest.raises(ValueError, match="buckets"):
        replace(table, buckets=3).read()
    other = table.rebucketed(3, str(tmp_path / "other"))
    assert other.read().count() == 2 and other.offsets().collect() == table.offsets().collect()


def test_reload_after_truncate(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key"})
    for _ in range(2):
        s.apply(text_log(spark, A), 0)
        assert s.table("people").read().count() == 2
        s.table("people").truncate()
        assert s.table("people").read().count() == 0


def test_texts_are_not_passed_through_a_redaction(spark, tmp_path):
    s = sink(spark, tmp_path, {"processors": "value.projection", "value.projection.type": "blacklist", "value.projection.list": "name"})
    s.value_decoder = None
    with pytest.raises(ValueError):
        s.apply(text_log(spark, A), 0)


def test_a_bucket_is_cut_into_tasks(spark, tmp_path, monkeypatch):
    """What one task merges does not grow with the table: a large bucket is written by several tasks."""
    from tidefold.operators import keyless
    from tidefold.sinks import bucket_table
    from tidefold.streaming import sink as sinking

    monkeypatch.setattr(bucket_table, "TASK_ROWS", 200)
    monkeypatch.setattr(sinking, "SCAN_ROWS", 100)
    row = "struct<a:bigint,b:string>"
    event = lambda op, before, after: F.struct(F.lit(op).alias("op"), before.cast(row).alias("before"), after.cast(row).alias("after"))
    image, none = F.struct(F.least("id", F.lit(2000)).alias("a"), F.lit("x").alias("b")), F.lit(None)
    place = lambda df, n: df.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") + n).alias("offset"),
                                    F.lit(None).cast("timestamp").alias("timestamp"), F.lit("CREATE_TIME").alias("timestamp_type"),
                                    F.lit(None).cast("struct<id:bigint>").alias("key"), "value")
    s = ConfiguredSink(spark, Settings({"cdc.handler": "mysql", "keyless": "true"}), str(tmp_path), buckets=2)
    # one image 3,000 times, 2,000 others once; then a tenth of the others is taken away
    s.apply(place(spark.range(5000).withColumn("value", event("c", none, image)), 0), 0)
    s.apply(place(spark.range(2000).filter("id % 10 = 0").withColumn("value", event("d", image, none)), 10_000), 1)
    rows = s.rows("t").groupBy("a").count().collect()
    assert {r["a"]: r["count"] for r in rows} == {**{i: 1 for i in range(2000) if i % 10}, 2000: 3000}
    table = s.table("t")
    for bucket, (version, _) in table.manifest().buckets.items():
        files = spark.read.parquet(f"{table.path}/data/v={version}/_bucket={bucket}").inputFiles()
        assert len(files) >= 4
    placed = table.read(with_bucket=True).select((table.bucket() == F.col("_bucket")).alias("right"), keyless.COUNT)
    assert placed.filter("NOT right").isEmpty()


def test_buckets_are_merged_in_turns(spark, tmp_path, monkeypatch):
    """What a merge shuffles does not grow with the table, and leaves the disk when its turn ends."""
    import os

    from tidefold.sinks import bucket_table
    from tidefold.sinks.folders import FREED

    monkeypatch.setattr(bucket_table, "TURN_ROWS", 500, raising=False)
    row = "struct<a:bigint,b:string>"
    event = lambda op, before, after: F.struct(F.lit(op).alias("op"), before.cast(row).alias("before"), after.cast(row).alias("after"))
    image, other, none = F.struct("id", F.lit("x")), F.struct("id", F.lit("y")), F.lit(None)
    place = lambda df, n: df.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") + n).alias("offset"),
                                    F.lit(None).cast("timestamp").alias("timestamp"), F.lit("CREATE_TIME").alias("timestamp_type"),
                                    F.lit(None).cast("struct<id:bigint>").alias("key"), "value")

    def shuffled() -> dict[str, int]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f: os.path.getsize(f) for f in files.split("\n") if "shuffle_" in f and f.endswith(".data") and os.path.exists(f)}

    s = ConfiguredSink(spark, Settings({"cdc.handler": "mysql", "keyless": "true"}), str(tmp_path), buckets=2)
    there = set(shuffled())
    s.apply(place(spark.range(3000).withColumn("value", event("c", none, image)), 0), 0)
    left = {f: n for f, n in shuffled().items() if f not in there}
    changes = spark.range(3000).filter("id % 10 = 0").withColumn("value", event("d", image, none)).unionByName(
        spark.range(3000).filter("id % 10 = 1").withColumn("value", event("u", image, other)))
    s.apply(place(changes, 10_000), 1)
    rows = s.rows("t").collect()
    assert sorted((r["a"], r["b"]) for r in rows) == [(i, "y" if i % 10 == 1 else "x") for i in range(3000) if i % 10]
    table = s.table("t")
    # 3,600 rows in 8 turns: four parts of each bucket, each written by itself
    writers = {f.rsplit("/", 1)[1].split("-", 2)[2].split(".")[0] for f in table.read().inputFiles()}
    assert len(writers) == 8 and table.read().groupBy("k").count().filter("count > 1").isEmpty()
    assert table.read().agg(F.max(F.length("k"))).first()[0] == 22
    assert sum(left.values()) < 10_000 and spark.conf.get(FREED) == "false"
