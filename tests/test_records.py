"""Types, decoders, identity, write models, change events, settings, routes and tables on small fixtures."""

import base64
import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F, types as T

from tidefold.functions import ids, jsontext
from tidefold.functions.normalise import TypeOptions, logical, normalise, schema_from_envelope, unsupported
from tidefold.model import DELETE, REPLACE, SET, log_schema
from tidefold.operators import (
    audit, cdc_document as cdoc, cdc_relational as crel, errors, evolve, fold, merge, project as prj, route, writemodel as wm,
)
from tidefold.plans.settings import Settings
from tidefold.plans.target_plan import TargetPlan, plans_for
from tidefold.sinks import folders
from tidefold.sinks.bucket_table import BucketTable
from tidefold.sources import changelog, decode as dec
from tidefold.streaming import apply as st

UTC = dt.timezone.utc


def one(spark, value, fields, opts=TypeOptions()):
    schema = T.StructType([T.StructField("value", T.StructType(fields))])
    return normalise(spark.createDataFrame([(value,)], schema), "value", opts).first()


def fld(name, dtype, kind=None, **meta):
    return T.StructField(name, dtype, True, logical(kind, **meta))


# -- types ------------------------------------------------------------------


def test_document_of_all_types(spark):
    fields = [
        fld("_id", T.StringType()), fld("title", T.StringType()), fld("pages", T.IntegerType()),
        fld("lent", T.BooleanType()), fld("shelf", T.StructType([fld("room", T.StringType())])),
        fld("tags", T.ArrayType(T.StringType())),
        fld("parts", T.ArrayType(T.StructType([fld("name", T.StringType()), fld("from", T.IntegerType())]))),
        fld("loans", T.MapType(T.StringType(), T.IntegerType())), fld("cover", T.BinaryType()),
        fld("bought", T.IntegerType(), "date"), fld("seen", T.LongType(), "timestamp"),
        fld("opens", T.LongType(), "time"), fld("price", T.DecimalType(20, 4)),
    ]
    day = 20_000  # days since 1970
    value = (
        "b-1", "Tides", 310, False, ("north",), ["sea", "moon"], [("ebb", 1), ("flood", 150)], {"may": 3, "june": 4},
        bytearray(b"\x00\xff"), day, day * 86_400_000 + 1, 33_300_000, decimal.Decimal("19.9050"),
    )
    v = one(spark, value, fields)["value"]
    assert v["shelf"]["room"] == "north" and list(v["tags"]) == ["sea", "moon"] and bytes(v["cover"]) == b"\x00\xff"
    assert [tuple(x) for x in v["parts"]] == [("ebb", 1), ("flood", 150)] and v["loans"]["june"] == 4
    assert v["bought"] == dt.date(1970, 1, 1) + dt.timedelta(days=day) and v["price"] == decimal.Decimal("19.9050")
    assert v["seen"] == dt.datetime(2024, 10, 4, 0, 0, 0, 1000)
    assert v["opens"] == dt.datetime(1970, 1, 1, 9, 15)
    legacy = one(spark, value, fields, TypeOptions(legacy_decimal=True))["value"]
    assert legacy["price"] == 19.905


@pytest.mark.parametrize("kind,dtype,raw,expected", [
    ("local_ms", T.LongType(), 28_800_000, dt.datetime(1970, 1, 1)),
    ("local_us", T.LongType(), 28_800_001_999, dt.datetime(1970, 1, 1, 0, 0, 0, 1000)),
    ("local_us", T.LongType(), 28_799_999_999, dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
    ("local_us", T.LongType(), None, None),
    ("zoned", T.StringType(), "2020-02-29T10:15:30.5+01:00", dt.datetime(2020, 2, 29, 9, 15, 30, 500000)),
    ("epoch_day", T.IntegerType(), -1, -1),
])
def test_logical_types(spark, kind, dtype, raw, expected):
    assert one(spark, (raw,), [fld("x", dtype, kind)])["value"]["x"] == expected


@pytest.mark.parametrize("dtype,raw", [
    (T.ByteType(), -128), (T.ByteType(), 127), (T.ShortType(), -32768), (T.ShortType(), 32767),
    (T.IntegerType(), -(2**31)), (T.LongType(), 2**63 - 1), (T.FloatType(), 1.5), (T.DoubleType(), 1e300),
    (T.BooleanType(), False), (T.StringType(), ""),
])
def test_scalars(spark, dtype, raw):
    assert one(spark, (raw,), [fld("x", dtype)])["value"]["x"] == raw


def test_null_rule(spark):
    need = lambda **m: one(spark, (None,), [fld("x", T.StringType(), **m)])
    assert need(optional=True)["value"]["x"] is None
    assert need(optional=True, default="d")["value"]["x"] == "d"
    assert need(optional=False, default="d")["value"]["x"] == "d"
    assert need(optional=False)["err"] == "required field x is null"
    listed = one(spark, (["a", None],), [fld("x", T.ArrayType(T.StringType()), optional=False)])
    assert listed["err"] == "required field x holds null"
    assert one(spark, ("soon",), [fld("x", T.StringType(), "zoned")])["err"] == "field x is no time"


def test_containers_in_containers_are_unsupported(spark):
    nested = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.ArrayType(T.ArrayType(T.LongType())))]))])
    assert unsupported(nested) == ["a.b"]
    with pytest.raises(ValueError):
        normalise(spark.createDataFrame([], T.StructType([T.StructField("value", nested)])))


def test_schema_from_envelope():
    schema = schema_from_envelope(json.dumps({"type": "struct", "fields": [
        {"field": "a", "type": "int8"},
        {"field": "d", "type": "bytes", "name": "org.apache.kafka.connect.data.Decimal", "parameters": {"scale": "3"}},
        {"field": "m", "type": "map", "values": {"type": "array", "items": {"type": "string"}}, "optional": True},
    ]}))
    assert [f.dataType.simpleString() for f in schema] == ["tinyint", "binary", "map<string,array<string>>"]
    assert schema["d"].metadata["scale"] == 3
    assert [f.metadata["optional"] for f in schema] == [False, False, True]
    with pytest.raises(ValueError):
        schema_from_envelope('{"type": "struct", "fields": [{"field": "a", "type": "uint9"}]}')


@pytest.mark.parametrize("text,scale", [
    ("12345.6789", 4), ("-0.01", 2), ("0.00", 2), ("-128", 0), ("99999999999999999999999999999999.123456", 6),
    ("-99999999999999999999999999999999.999999", 6), ("18446744073709551616", 0), ("0.000000000000000001", 18),
    ("100000000000000000000000000000000000000", 0), ("-1000000000000000000000000000000000000000000", 0),
])
def test_decimals_in_json_with_schema(spark, text, scale):
    unscaled = int(text.replace(".", ""))
    raw = unscaled.to_bytes(max(1, (unscaled + (unscaled < 0)).bit_length() // 8 + 1), "big", signed=True)
    schema = schema_from_envelope(json.dumps({"type": "struct", "fields": [{
        "field": "d", "type": "bytes", "name": "org.apache.kafka.connect.data.Decimal", "parameters": {"scale": str(scale)}}]}))
    payload = json.dumps({"schema": None, "payload": {"d": base64.b64encode(raw).decode()}})
    row = dec.decode(spark.createDataFrame([(payload,)], "value string"), value=dec.JsonWithSchema(schema)).first()
    if len(decimal.Decimal(text).as_tuple().digits) > 38:
        assert row["err"] == "field d has too many digits"
    else:
        assert row["err"] is None and row["value"]["d"] == decimal.Decimal(text)


# -- decoders ---------------------------------------------------------------


def test_formats_give_the_same_document(spark):
    schema = T.StructType([fld("myField", T.StringType())])
    typed = spark.sql("SELECT named_struct('myField', 'some text') AS value")
    plain = spark.createDataFrame([('{"myField": "some text"}',)], "value string")
    carried = spark.createDataFrame([('{"schema": 1, "payload": {"myField": "some text"}}',)], "value string")
    assert dec.decode(typed, value=dec.Struct()).first()["value"]["myField"] == "some text"
    assert dec.decode(plain, value=dec.JsonPlain(schema)).first()["value"]["myField"] == "some text"
    assert dec.decode(carried, value=dec.JsonWithSchema(schema)).first()["value"]["myField"] == "some text"
    assert dec.decode(plain, value=dec.JsonRaw()).first()["value"] == '{"myField":"some text"}'


def test_bad_payloads_get_reasons(spark):
    df = spark.createDataFrame([("{oops",), ('{"n": "x"}',), ("[1]",), (None,), ('{"n": 1}',)], "value string")
    got = dec.decode(df, value=dec.JsonPlain(T.StructType([fld("n", T.IntegerType())])))
    assert [r["err"] is not None for r in got.collect()] == [True, True, True, False, False]
    raw = dec.decode(df, value=dec.JsonRaw()).collect()
    assert [r["err"] is not None for r in raw] == [True, False, True, False, False]
    missing = dec.require_payload(df).collect()
    assert [r["err"] for r in missing] == [None, None, None, "value is null", None]


def test_error_modes(spark):
    df = errors.add_error(spark.range(4), F.when(F.col("id") == 2, F.lit("two")))
    assert errors.settle(df, "reject").count() == 3 and errors.rejected(df).count() == 1
    with pytest.raises(Exception, match="bad record: two"):
        errors.settle(df, "failfast").collect()
    with pytest.raises(ValueError):
        errors.settle(df, "ignore")


def test_kafka_rows(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), None, "t", 1, 2, dt.datetime(2020, 1, 1), 1)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int",
    )
    row = changelog.from_kafka(raw).first()
    assert (row["key"], row["value"], row["timestamp_type"]) == (b"k", None, "LOG_APPEND_TIME")


# -- identity ---------------------------------------------------------------


def record(spark, key=("K", 1, "x"), value=("V", 5)):
    schema = log_schema("_id string, keyPart1 int, keyPart2 string", "_id string, a int")
    row = ("harbour.tides", 7, 40_000_000_123, None, None, key, value)
    return spark.createDataFrame([row], schema)


def made(spark, strategy, **kw):
    df = record(spark, **kw)
    col, errs = strategy(df)
    return df.select(col.alias("id"), errors.first_error(*errs).alias("err")).first()


def test_id_strategies(spark):
    assert len(made(spark, ids.object_id)["id"]) == 24 and len(made(spark, ids.random_object_id)["id"]) == 24
    assert len(made(spark, ids.uuid)["id"]) == 36
    assert made(spark, ids.object_id) == made(spark, ids.object_id)
    assert made(spark, ids.log_position)["id"] == "harbour.tides#7#40000000123"
    assert json.loads(made(spark, ids.full_key)["id"]) == {"_id": "K", "keyPart1": 1, "keyPart2": "x"}
    assert made(spark, ids.full_key, key=None)["id"] == "{}"
    part = ids.strategy("partial_key", prj.Blacklist.of("keyPart1"))
    assert json.loads(made(spark, part)["id"]) == {"_id": "K", "keyPart2": "x"}
    part = ids.strategy("partial_value", prj.Whitelist.of("a"))
    assert json.loads(made(spark, part)["id"]) == {"_id": "V", "a": 5}
    assert made(spark, part, value=None)["id"] == "{}"
    assert made(spark, ids.provided_in_key)["id"] == "K" and made(spark, ids.provided_in_value)["id"] == "V"
    assert made(spark, ids.provided_in_key, key=(None, 1, "x"))["err"] == "key holds no _id"
    assert made(spark, ids.provided_in_value, value=None)["err"] == "value holds no _id"
    for bad in ("nope", "partial_key"):
        with pytest.raises(ValueError):
            ids.strategy(bad)


# -- write models -----------------------------------------------------------


def test_write_models(spark):
    now = F.timestamp_millis(F.lit(1000))
    first = lambda model, df=None, **kw: wm.write_ops(df if df is not None else record(spark, **kw), model).first()
    assert first(wm.replace_by_id).asDict(True)["doc"] == {"_id": "V", "a": 5}
    stamped = first(wm.set_with_timestamps(now))
    assert stamped["op"] == SET and stamped["upsert"] and stamped["doc"]["_modifiedTS"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    with pytest.raises(ValueError):
        wm.replace_by_business_key(record(spark))
    people = spark.sql(
        "SELECT 't' topic, 0 partition, 0L offset, null key, named_struct('_id', named_struct('port', 'G', "
        "'pier', 'M'), 'depth', 15) value"
    )
    keyed = first(wm.replace_by_business_key, people)
    assert keyed["k"].asDict() == {"port": "G", "pier": "M"} and keyed["doc"].asDict() == {"depth": 15}
    assert wm.write_ops(record(spark, value=None), wm.replace_by_id).count() == 0
    gone = wm.write_ops(record(spark, value=None), wm.replace_by_id, wm.delete_by_id(ids.provided_in_key)).first()
    assert (gone["op"], gone["k"], gone["doc"]) == (DELETE, "K", None)
    nothing = record(spark, key=None, value=None)
    assert wm.write_ops(nothing, wm.replace_by_id, wm.delete_by_id(ids.provided_in_key)).count() == 0


# -- change events ----------------------------------------------------------

IMAGE = "struct<id:int,label:string>"


def events(spark, rows, key="id int"):
    schema = log_schema(key, f"op string, before {IMAGE}, after {IMAGE}")
    return spark.createDataFrame([("t", 0, i, None, None, k, v) for i, (k, v) in enumerate(rows)], schema)


def test_relational_events(spark):
    rows = [
        ((1,), ("c", None, (1, "A"))), ((1,), ("u", (1, "A"), (1, "B"))), ((2,), ("r", None, (2, "C"))),
        ((2,), ("d", (2, "C"), None)), ((2,), None), ((3,), ("x", None, None)), ((3,), (None, None, None)),
        ((4,), ("c", None, None)), ((5,), ("c", None, (None, None))), (None, ("d", (9, "Z"), None)),
    ]
    ops = crel.relational_ops(events(spark, rows)).orderBy("offset").collect()
    assert [r["op"] for r in ops[:4]] == [REPLACE, REPLACE, REPLACE, DELETE]
    assert ops[1].asDict(True)["doc"] == {"_id": {"id": 1}, "label": "B"}
    assert [r["err"] for r in ops[4:]] == [
        "op is not handled: x", "op is missing", "after is missing or empty", "after is missing or empty", "key is missing",
    ]
    only = crel.relational_ops(events(spark, rows), operations={"c": crel.Built(REPLACE)})
    assert [r["err"] for r in only.orderBy("offset").take(2)] == [None, "op is not handled: u"]


def test_op_of_another_type_is_missing(spark):
    df = spark.sql("SELECT 't' topic, 0 partition, 0L offset, named_struct('id', 1) key, "
                   "named_struct('op', 99, 'after', named_struct('id', 1)) value")
    assert crel.relational_ops(df).first()["err"] == "op is missing"


DOC = "op string, after string, patch string"


def doc_events(spark, rows):
    schema = log_schema("id string", DOC)
    return spark.createDataFrame([("t", 0, i, None, None, k, v) for i, (k, v) in enumerate(rows)], schema)


def test_document_events(spark):
    rows = [
        (("77",), ("c", '{_id: 77, berth: "north"}', None)),
        (("77",), ("u", None, '{"$set": {pilot: "A", "n": {"x": 1}}, "$unset": {"berth": ""}}')),
        (("77",), ("u", None, '{"$v": 1, "_id": 77, "flag": "e"}')),
        (("77",), ("d", None, None)),
        (("77",), None),
        ((None,), ("d", None, None)),
        (("not json",), ("d", None, None)),
        (("1",), ("c", "not json", None)),
        (("1",), ("c", '{"a": 1}', None)),
        (("1",), ("u", None, None)),
        (("1",), (None, None, None)),
        (None, ("c", '{"_id": 1}', None)),
    ]
    ops = cdoc.document_ops(doc_events(spark, rows)).orderBy("offset").collect()
    assert [(r["op"], r["k"], r["upsert"]) for r in ops[:4]] == [
        (REPLACE, "77", True), (SET, "77", False), (REPLACE, "77", True), (DELETE, "77", False),
    ]
    assert ops[1]["sets"] == {"pilot": '"A"', "n": '{"x":1}'} and ops[1]["unsets"] == ["berth"]
    assert ops[2]["sets"] == {"_id": "77", "flag": '"e"'}
    assert [r["err"] for r in ops[4:]] == [
        "key id is no JSON text", "key id is no JSON text", "after is no JSON object", "after holds no _id",
        "patch is no JSON object", "op is missing", "key is missing",
    ]
    row = cdoc.document_ops(doc_events(spark, rows[1:2]), "row").first()
    assert row["sets"] == {"pilot": '"A"', "n": '{"x":1}', "berth": "null"} and row["unsets"] == []


def test_canonical_keys(spark):
    texts = ['{"b": 2.50, "a": "x"}', '{"a": "x", "b": 2.5}', "{oops", '{"a":1,"a":2}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(jsontext.canonical(F.col("t")).alias("c"))
    assert [r["c"] for r in df.collect()] == ['{"a":"x","b":2.5}'] * 2 + [None, None]


# -- settings, routes, audits -----------------------------------------------


def test_settings_fall_back():
    s = Settings({"write.model": "timestamps", "write.model.a": "replace", "route.t1": "a", "delete.on.null.a": "TRUE"})
    assert [s.get("write.model", t) for t in ("a", "b", "")] == ["replace", "timestamps", "timestamps"]
    assert s.get("id.strategy", "a") == "object_id" and s.routes() == {"t1": "a"}
    assert s.flag("delete.on.null", "a") and not s.flag("delete.on.null", "b") and s.number("max.batch.size") == 0
    with pytest.raises(KeyError):
        s.get("unknown")


def test_plans_are_validated():
    plan = lambda **kw: TargetPlan(Settings({k.replace("_", "."): v for k, v in kw.items()}))
    with pytest.raises(ValueError):
        plan(cdc_handler="oracle9").handler()
    with pytest.raises(ValueError):
        plan(write_model="append").write_model()
    with pytest.raises(ValueError):
        plan(processors="shout").steps()
    with pytest.raises(ValueError):
        plan(delete_on_null="true", id_strategy="uuid").delete_model()
    assert plan(delete_on_null="true", id_strategy="full_key").delete_model() is not None
    assert len(plan(processors="log.metadata,value.projection,log.metadata").steps()) == 3
    assert set(plans_for(Settings({"targets": "a, b"}))) == {"", "a", "b"}


def test_batch_sizes(spark):
    df = spark.range(50).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("x").alias("target"))
    for size in (0, 1, 7, 49, 50, 60):
        got = route.number_batches(df, size, width=9).groupBy("batch").count().orderBy("batch").collect()
        want = [50] if not size else [min(size, 50 - i) for i in range(0, 50, size)]
        assert [r["count"] for r in got] == want


def test_schema_growth(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": {"x": 1}}',), ('{"a": 2.5, "c": [1]}',)], "doc string")
    found = evolve.infer(docs)
    assert {f.name: f.dataType.simpleString() for f in found} == {"a": "decimal(21,1)", "b": "struct<x:bigint>", "c": "array<bigint>"}
    have = T.StructType.fromDDL("a int, d string")
    assert [f.name for f in evolve.new_fields(have, found)] == ["b", "c"]
    assert evolve.grown(have, found).simpleString() == "struct<a:decimal(21,1),d:string,b:struct<x:bigint>,c:array<bigint>>"
    assert evolve.wider(T.LongType(), T.StringType()) == T.StringType()
    mixed = evolve.union_grown(spark.sql("SELECT 1 id, named_struct('x', 1) v"), spark.sql("SELECT 2L id, 'text' v"))
    assert sorted((r["id"], r["v"]) for r in mixed.collect()) == [(1, '{"x":1}'), (2, "text")]


# -- tables -----------------------------------------------------------------


def latest(target, delta):
    target = target if target is not None else delta.select("k", "doc").limit(0)
    return merge.merge_latest(target, delta)


def delta_of(spark, rows):
    return spark.createDataFrame(rows, "k int, op string, doc struct<a:int>, ord bigint")


def test_table_rewrites_touched_buckets_only(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), ("k",), 4)
    assert t.read() is None
    t.apply(delta_of(spark, [(i, REPLACE, (i,), i) for i in range(40)]), latest, 0)
    before = t.manifest().buckets
    t.apply(delta_of(spark, [(7, DELETE, None, 50), (99, DELETE, None, 51)]), latest, 1)
    changed = {b for b, v in t.manifest().buckets.items() if v != before[b]}
    assert 1 <= len(changed) <= 2
    assert sorted(r["k"] for r in t.read().collect()) == [i for i in range(40) if i != 7]
    # the same batch again changes nothing, an unfinished one leaves no trace
    t.apply(delta_of(spark, [(1, DELETE, None, 60)]), latest, 1)
    spark.range(3).write.parquet(str(tmp_path / "t" / "data" / "v=2"))
    assert t.read().count() == 39
    # another source counts its own batches
    t.apply(delta_of(spark, [(0, DELETE, None, 70)]), latest, 0, source="other")
    assert t.read().count() == 38 and t.manifest().applied == {"": 1, "other": 0}
    files = {b: t.read([b]).inputFiles() for b in t.manifest().buckets}
    assert all(len(f) == 1 for f in files.values())
    t.expire()
    assert t.read().count() == 38 and len(folders.children(spark, str(tmp_path / "t" / "manifest"))) == 1
    assert t.register("kept_rows").count() == spark.sql("SELECT * FROM kept_rows").count() == 38
    t.truncate()
    assert t.read().count() == 0 and t.schema().names == ["k", "doc"]


def test_table_takes_wider_schemas(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), ("k",), 2)

    def grow_into(target, delta):
        rows = delta.select("k", "doc")
        return rows if target is None else evolve.union_grown(target.join(rows, "k", "left_anti"), rows)

    t.apply(spark.sql("SELECT id AS k, named_struct('a', CAST(id AS INT)) doc FROM range(6)"), grow_into, 0)
    t.apply(spark.sql("SELECT id + 5 AS k, named_struct('a', 'x', 'b', id) doc FROM range(2)"), grow_into, 1)
    assert {r["k"]: tuple(r["doc"]) for r in t.read().collect()} == {
        **{i: (str(i), None) for i in range(5)}, 5: ("x", 0), 6: ("x", 1),
    }


def test_one_exchange_per_side_of_a_table_merge(spark, tmp_path):
    """Both sides are shuffled by bucket once, and each bucket is written by one task."""
    t = BucketTable(spark, str(tmp_path / "t"), ("k",), 4)
    plans = []

    def spy(target, delta):
        out = latest(target, delta)
        plans.append(out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0])
        return out

    for batch in range(2):
        t.apply(delta_of(spark, [(i, REPLACE, (i,), i) for i in range(30)]), spy, batch)
    assert plans[1].count("Exchange hashpartitioning(k") == plans[1].count("REPARTITION_BY_NUM") <= 2
    assert all(len(t.read([b]).inputFiles()) == 1 for b in t.manifest().buckets)


def test_restart_of_an_unfinished_batch(spark, tmp_path):
    """A batch that failed while merging is applied whole when it is run again."""
    t = BucketTable(spark, str(tmp_path / "t"), ("k",), 2)
    t.apply(delta_of(spark, [(i, REPLACE, (0,), i) for i in range(5)]), latest, 0)
    fail = lambda target, delta: latest(target, delta).withColumn("doc", F.raise_error(F.lit("lost")).cast("struct<a:int>"))
    with pytest.raises(Exception, match="lost"):
        t.apply(delta_of(spark, [(1, REPLACE, (9,), 9)]), fail, 1)
    assert t.manifest().version == 0
    t.apply(delta_of(spark, [(1, REPLACE, (9,), 9)]), latest, 1)
    assert {r["k"]: r["doc"]["a"] for r in t.read().collect()} == {0: 0, 1: 9, 2: 0, 3: 0, 4: 0}


def test_batches_and_streams_agree(spark, tmp_path):
    """The same log in one batch and in several micro-batches."""
    rows = [((i % 7,), ("c" if i % 5 else "d", None, (i % 7, f"n{i}") if i % 5 else None)) for i in range(60)]
    log = events(spark, rows)
    fold_it = lambda df: fold.fold_latest(errors.good(crel.relational_ops(df)))
    whole = BucketTable(spark, str(tmp_path / "whole"), ("k",), 3)
    st.apply_batch(whole, log, fold_it, latest, 0)
    path, streamed = str(tmp_path / "log"), BucketTable(spark, str(tmp_path / "streamed"), ("k",), 3)
    for i in range(4):
        log.filter((F.col("offset") >= 15 * i) & (F.col("offset") < 15 * (i + 1))).write.mode("append").parquet(path)
        stream = changelog.stream_log(spark, "parquet", path, log.schema)
        each = lambda df, batch: st.apply_batch(streamed, df, fold_it, latest, batch)
        st.apply_stream(stream, each, str(tmp_path / "checkpoint")).awaitTermination()
    rows_of = lambda t: sorted(map(str, t.read().collect()))
    assert rows_of(whole) == rows_of(streamed) and streamed.manifest().applied == {'': 3}
    assert streamed.offsets().first()["offset"] == 59


def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    assert audit.duplicate_keys(df, ["id"]).first().asDict() == {"id": 1, "n": 2}
    assert [r["v"] for r in audit.sample(df, ["id", "v"], 2).collect()] == ["a", "b"]
    assert [r["id"] for r in audit.missing_keys(spark.range(1, 5).selectExpr("CAST(id AS INT) id"), df, ["id"]).orderBy("id").collect()] == [3, 4]


def test_rules_reach_into_arrays_and_maps(spark):
    inner = T.StructType([fld("at", T.StringType(), "zoned"), fld("need", T.StringType(), optional=False)])
    lists, maps = fld("xs", T.ArrayType(inner)), fld("m", T.MapType(T.StringType(), inner))
    good, late, none = ("2020-02-29T10:15:30Z", "a"), ("soon", "a"), (None, None)
    assert one(spark, ([good],), [lists])["err"] is None and one(spark, ([good, None],), [lists])["err"] is None
    assert one(spark, ([good, late],), [lists])["err"] == "field xs.at is no time"
    assert one(spark, ({"a": late},), [maps])["err"] == "field m.at is no time"
    assert one(spark, ([none],), [lists])["err"] == "required field xs.need is null"


def test_payloads_of_a_broker_stay_bytes(spark):
    raw = spark.createDataFrame([("t", 0, 1, None, 0, bytearray(b'{"id":1}'), bytearray(b"\x00\x00\x00\x00\x07rest"))],
                                "topic string, partition int, offset bigint, timestamp timestamp, timestampType int, key binary, value binary")
    log = changelog.from_kafka(raw)
    assert bytes(log.select(dec.Avro("{}", header=5).body("value").alias("b")).first()["b"]) == b"rest"
    key = dec.JsonPlain(T.StructType.fromDDL("id int"))
    assert dec.decode(log, key).first()["key"]["id"] == 1
