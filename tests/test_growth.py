"""The configured sink where records leave fields out, columns grow, keys are missing, or topics meet."""

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from tests.test_sink import text_log
from tidefold.model import log_schema
from tidefold.plans.settings import Settings
from tidefold.sources import decode as dec
from tidefold.streaming.sink import ConfiguredSink


def sink(spark, path, values, key="id int", value=None, **kw):
    value = dec.JsonPlain(T.StructType.fromDDL(value)) if value else dec.JsonInferred()
    return ConfiguredSink(spark, Settings(values), str(path), buckets=2, key_decoder=dec.JsonPlain(T.StructType.fromDDL(key)), value_decoder=value, **kw)


def docs(s, target):
    return sorted((r["doc"].asDict(True) for r in s.table(target).read().collect()), key=str)


def test_absent_fields_keep_their_value(spark, tmp_path):
    values = {"write.model": "row_upsert", "id.strategy": "full_key", "processors": "id,value.projection,rename.mapping",
              "value.projection.type": "blacklist", "value.projection.list": "secret",
              "rename.mapping": '[{"oldName": "value.nm", "newName": "name"}]'}
    s = sink(spark, tmp_path, values, value="id int, nm string, age int, secret string", kind="row", row_keys={"people": ["id"]})
    s.apply(text_log(spark, [("people", {"id": 1}, {"id": 1, "nm": "a", "age": 1, "secret": "x"}), ("people", {"id": 2}, {"id": 2, "nm": "b", "age": 5})]), 0)
    more = text_log(spark, [("people", {"id": 0}, {"id": 0})] * 2 + [
        ("people", {"id": 1}, {"id": 1, "age": 2}), ("people", {"id": 2}, {"id": 2, "nm": None}), ("people", {"id": 2}, {"id": 2, "age": 6})])
    s.apply(more.filter("offset > 1"), 1)
    assert [(d["id"], d["name"], d["age"]) for d in docs(s, "people")] == [(1, "a", 2), (2, None, 6)]


def test_fields_that_appear_and_widen(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key"})
    batches = [{"id": 1, "n": 1}, {"id": 2, "n": 2.5, "d": {"x": 1}}, {"id": 3, "n": "t", "d": {"y": [1, 2]}}]
    for i, b in enumerate(batches):
        log = text_log(spark, [("a", {"id": 0}, {"id": 0})] * i + [("a", {"id": b["id"]}, b)])
        s.apply(log.filter(f"offset = {i}"), i)
    assert [(d["id"], d["n"], d["d"]) for d in docs(s, "a")] == [
        (1, "1", None), (2, "2.5", {"x": 1, "y": None}), (3, "t", {"x": None, "y": [1, 2]})]


def test_inferred_json_is_checked(spark, tmp_path):
    s = sink(spark, tmp_path, {"id.strategy": "full_key", "on.error": "reject"})
    rows = [("a", 0, i, None, None, '{"id":%d}' % i, v) for i, v in enumerate(['{"v":1}', "[1]", "no", '{"w":{"z":true}}'])]
    s.apply(spark.createDataFrame(rows, log_schema("string", "string")), 0)
    assert len(docs(s, "a")) == 2 and {r["offset"] for r in s.table("a").rejected().collect()} == {1, 2}


IMAGE = "id int, name string"
ENVELOPE = f"op string, before struct<{IMAGE}>, after struct<{IMAGE}>"


def keyless_events(op, before=None, after=None):
    return "lines", None, {"op": op, "before": before, "after": after}


def test_counted_images(spark, tmp_path):
    a, b = {"id": 1, "name": "a"}, {"id": 1, "name": None}
    s = sink(spark, tmp_path, {"cdc.handler": "mysql", "keyless": "true", "on.error": "reject"}, value=ENVELOPE)
    one = [keyless_events("c", after=a)] * 3 + [keyless_events("r", after=b), keyless_events("u", a, b)]
    s.apply(text_log(spark, one), 0)
    rows = lambda: sorted(((r["id"], r["name"]) for r in s.rows("lines").collect()), key=str)
    assert rows() == [(1, "a"), (1, "a"), (1, None), (1, None)]
    two = [*one, keyless_events("d", b), keyless_events("d", {"id": 9, "name": "z"}), keyless_events("d"), keyless_events("x"), keyless_events("u", a, a)]
    s.apply(text_log(spark, two), 1)
    assert rows() == [(1, "a"), (1, "a"), (1, None)]
    assert {r["err"] for r in s.table("lines").rejected().collect()} == {"image is not there", "before is missing or empty", "op is not handled: x"}


def test_missing_image_stops_the_job(spark, tmp_path):
    s = sink(spark, tmp_path, {"cdc.handler": "mysql", "keyless": "true"}, value=ENVELOPE)
    with pytest.raises(Exception, match="image is not there"):
        s.apply(text_log(spark, [keyless_events("d", {"id": 9, "name": "z"})]), 0)


def test_names_in_lower_case(spark, tmp_path):
    value = "op string, before struct<ID int, VAL string>, after struct<ID int, VAL string>"
    s = sink(spark, tmp_path, {"cdc.handler": "mysql", "lower.case.names": "true", "catalog": "cat", "database": "db", "max.batch.size": "1"},
             key="ID int", value=value, kind="row")
    s.apply(text_log(spark, [("t", {"ID": i}, {"op": "c", "after": {"ID": i, "VAL": "x"}}) for i in range(5)]), 0)
    assert docs(s, "t") == [{"id": i, "val": "x"} for i in range(5)]
    assert s.table("t").path.endswith("/cat/db/t")


def test_order_across_topics_and_batches(spark, tmp_path):
    """Times of a partition never run backwards, over batches either."""
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    row = lambda topic, offset, second, name: (topic, 0, offset, at(second), "CREATE_TIME", (1,), (1, name))
    schema = log_schema("id int", "id int, name string")
    s = ConfiguredSink(spark, Settings({"route.a": "t", "route.b": "t", "id.strategy": "full_key"}), str(tmp_path), buckets=2)
    s.apply(spark.createDataFrame([row("a", 5, 30, "late"), row("b", 90, 20, "early")], schema), 0)
    assert [d["name"] for d in docs(s, "t")] == ["late"]
    assert {(r["topic"], r["offset"], r["time"]) for r in s.table("t").offsets().collect()} == {("a", 5, at(30)), ("b", 90, at(20))}
    # a's clock runs backwards: its record still counts as of second 30, after b's
    s.apply(spark.createDataFrame([row("a", 6, 1, "a again"), row("b", 91, 25, "b again")], schema), 1)
    assert [d["name"] for d in docs(s, "t")] == ["a again"]


@pytest.mark.parametrize("topics", [1, 2])
def test_partial_rows_across_topics(spark, tmp_path, topics):
    """The first creating write after a reset is found in the order of times too."""
    at = lambda s: dt.datetime(2024, 1, 1, s // 3600, s // 60 % 60, s % 60)
    value = "op string, before struct<id int, n int>, after struct<id int, n int>"
    events = [("c", 1), ("d", None), ("u", 7), ("c", 2), ("u", 3)]
    rows = [(f"t{i % topics}", 0, 100 - i if topics > 1 else i, at(4000 * i), "CREATE_TIME", (1,), (op, (1, 0), None if n is None else (1, n)))
            for i, (op, n) in enumerate(events)]
    if topics > 1:  # offsets of a partition grow, those of the topics do not tell their order
        rows = [(t, p, i + (1000 if t == "t0" else 0), *rest) for i, (t, p, _, *rest) in enumerate(rows)]
    s = ConfiguredSink(spark, Settings({"route": "t", "cdc.handler": "mysql"}), str(tmp_path), kind="row", buckets=2)
    s.apply(spark.createDataFrame(rows, log_schema("id int", value)), 0)
    assert docs(s, "t") == [{"id": 1, "n": 3}]


def test_writer_schemas(spark, monkeypatch):
    """Records of two schemas, decoded by a stand-in for the Avro module, which is not on this machine."""
    import sys
    import types

    from pyspark.sql import functions as F

    stand_in = types.ModuleType("pyspark.sql.avro.functions")
    stand_in.from_avro = lambda body, schema: F.from_json(body.cast("string"), schema)
    monkeypatch.setitem(sys.modules, "pyspark.sql.avro.functions", stand_in)
    head = lambda i: b"\x00" + i.to_bytes(4, "big")
    rows = [head(3) + b'{"id":1,"n":5}', head(70_000) + b'{"id":2,"n":"t","d":{"x":true}}', None, head(9) + b"{}", b"{}"]
    log = spark.createDataFrame([("t", 0, i, None, None, None, r and bytearray(r)) for i, r in enumerate(rows)], log_schema("binary", "binary"))
    decoder = dec.AvroRegistry({3: "id int, n int", 70_000: "id bigint, n string, d struct<x: boolean>"})
    got = decoder(log, "value").orderBy("offset").collect()
    assert [r["value"] and r["value"].asDict(True) for r in got] == [
        {"id": 1, "n": "5", "d": None}, {"id": 2, "n": "t", "d": {"x": True}}, None, None, None]
    assert [r["err"] for r in got] == [None, None, None] + ["value is of an unknown schema"] * 2


def test_rates_hold_few_windows(spark, tmp_path):
    """Closed windows are written once and leave the state."""
    from tidefold.streaming.apply import append_rates

    path, start = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    held = []
    for batch in range(4):
        times = [(start + dt.timedelta(hours=batch * 24 + i),) for i in range(24)] + ([(start + dt.timedelta(hours=40),)] if batch == 3 else [])
        spark.createDataFrame(times, "ts timestamp").coalesce(1).write.mode("append").parquet(path)
        query = append_rates(spark.readStream.schema("ts timestamp").parquet(path), "ts", "1 hour", "2 hours", str(tmp_path / "out"), str(tmp_path / "c"))
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    done = spark.read.parquet(str(tmp_path / "out")).collect()
    assert max(held) <= 4 and len(done) == len({r["start"] for r in done}) >= 90 and {r["n"] for r in done} == {1}


def test_deletes_by_the_key_itself(spark, tmp_path):
    """Where ids come from the value, a record without one deletes by its key."""
    values = {"id.strategy": "provided_in_value", "delete.on.null": "true", "delete.model": "key"}
    s = sink(spark, tmp_path, values, key="_id string", value="_id string, n int")
    s.apply(text_log(spark, [("a", {"_id": k}, {"_id": k, "n": i}) for i, k in enumerate("xy")]), 0)
    s.apply(text_log(spark, [("a", {"_id": "x"}, {"_id": "x", "n": 0}), ("a", {"_id": "y"}, {"_id": "y", "n": 1}), ("a", {"_id": "x"}, None)]), 1)
    assert [d["_id"] for d in docs(s, "a")] == ["y"]


def test_one_dialect_of_regular_expressions(spark):
    """Struct fields and map keys follow the same expressions."""
    from pyspark.sql import functions as F

    from tidefold.operators import rename as ren

    rules = [ren.NameRule(r"value\.\w++(\.\p{Lower}+)*", r"(?<a>[a-z&&[^q]])(\w*)", "${a}_$2")]
    df = spark.sql("SELECT named_struct('abc', 1, 'qrs', 2, 'm', map('abc', 1, 'q', 2)) value")
    out = ren.rename(df, ren.ByRegExp(rules), ["value"])
    names = out.schema["value"].dataType.names
    assert names[:2] == ["a_bc", "qr_s"] and set(out.select(F.explode(F.map_keys(F.col("value").getField(names[2]))).alias("k")).toPandas()["k"]) == {"a_bc", "q"}
