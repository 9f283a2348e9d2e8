"""Sources, decoders, type normalisation, identity, routing and bad records."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.logs import (
    DOCS_SQL, ORDER_IMAGE, ORDERS_LOG_SQL, as_text, order_documents, orders_log,
)
from checks.support import cents, check, flat, table
from tidefold.functions import ids, jsontext
from tidefold.functions.normalise import TypeOptions, logical, normalise, schema_from_envelope
from tidefold.model import log_schema
from tidefold.operators import errors, project as prj, route as rte, writemodel
from tidefold.sinks.folders import shared_folder
from tidefold.sources import changelog, decode as dec

ENVELOPE = f"struct<op:string,before:{ORDER_IMAGE},after:{ORDER_IMAGE}>"
KEY_TYPE = T.StructType([T.StructField("id", T.LongType())])


def value_type() -> T.StructType:
    return T.StructType.fromDDL(ENVELOPE)


def log_rows(df: DataFrame) -> DataFrame:
    """The log as flat rows."""
    return df.select(
        "topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.unix_millis("timestamp").alias("ms"),
        F.col("key.id").alias("k"), F.col("value.op").alias("op"), F.col("value.after.status").alias("after_status"),
        F.col("value.after.cents").alias("after_cents"),
    )


LOG_ROWS_SQL = f"WITH {ORDERS_LOG_SQL} SELECT topic, part, off, ms, k, op, after_status, after_cents FROM log9"


@check("src_changelog_scan", LOG_ROWS_SQL)
def src_changelog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of JSON text, written to the shared folder and scanned back."""
    path = shared_folder(spark, "log")
    as_text(orders_log(spark, sf_dir)).write.parquet(path)
    log = changelog.read_log(spark, "parquet", path, log_schema("string", "string"))
    return log_rows(dec.decode(log, dec.JsonPlain(KEY_TYPE), dec.JsonPlain(value_type())))


@check("src_snapshot_replay", f"WITH {ORDERS_LOG_SQL} SELECT part, coalesce(op, '-') AS op, count(*) AS n, min(off) AS first, max(off) AS last FROM log9 GROUP BY ALL")
def src_snapshot_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log replayed to its end as a stream, counted per partition and op."""
    path, out, state = (shared_folder(spark, n) for n in ("log", "replay", "state"))
    orders_log(spark, sf_dir).write.parquet(path)
    stream = changelog.stream_log(spark, "parquet", path, log_schema(KEY_TYPE, ENVELOPE))
    rows = stream.select("partition", "offset", F.coalesce("value.op", F.lit("-")).alias("op"))
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(out).groupBy(F.col("partition").alias("part"), "op").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )


@check("src_schemaful_struct", LOG_ROWS_SQL)
def src_schemaful_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(dec.decode(orders_log(spark, sf_dir), dec.Struct(), dec.Struct()))


SCHEMA_TEXT = """{"type": "struct", "fields": [
  {"field": "id", "type": "int64"},
  {"field": "status", "type": "string", "optional": true, "default": "?"},
  {"field": "day", "type": "int32", "name": "io.debezium.time.Date"},
  {"field": "at", "type": "int64", "optional": true, "name": "org.apache.kafka.connect.data.Timestamp"}]}"""


@check("src_json_schema_payload", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN '?' ELSE o_orderstatus END AS status,
  CAST(epoch_ms(o_orderdate) // 86400000 AS BIGINT) AS day, CASE WHEN o_orderkey % 2 = 0 THEN epoch_ms(o_orderdate) + 5 END AS at FROM orders""")
def src_json_schema_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, ms = F.col("o_orderkey"), F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    payload = F.struct(
        k.alias("id"), F.when(k % 3 != 0, F.col("o_orderstatus")).alias("status"),
        F.unix_date(F.to_date("o_orderdate")).alias("day"), F.when(k % 2 == 0, ms + 5).alias("at"),
    )
    log = o.select(F.to_json(F.struct(F.lit("left to the reader").alias("schema"), payload.alias("payload"))).alias("value"))
    df = dec.decode(log, value=dec.JsonWithSchema(schema_from_envelope(SCHEMA_TEXT)))
    return flat(errors.good(df), "value")


@check("src_json_plain", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src_json_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    df = dec.decode(e, value=dec.JsonPlain(T.StructType([T.StructField("k", T.LongType())])))
    return errors.good(df).select("event_id", "value.k")


@check("src_json_raw", """SELECT o_orderkey AS k, o_orderkey AS i, o_totalprice AS d, o_orderstatus AS s, o_orderkey % 2 = 0 AS b FROM orders""")
def src_json_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers come out as integers or doubles by their spelling; no logical types."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    doc = F.struct(F.col("o_totalprice").alias("d"), k.alias("i"), F.col("o_orderstatus").alias("s"), (k % 2 == 0).alias("b"))
    df = errors.good(dec.decode(o.select("o_orderkey", F.to_json(doc).alias("value")), value=dec.JsonRaw()))
    v = F.parse_json("value")
    got = lambda n, t: F.variant_get(v, f"$.{n}", t).alias(n)
    return df.select(k.alias("k"), got("i", "bigint"), got("d", "double"), got("s", "string"), got("b", "boolean"))


@check("src_mixed_key_value", LOG_ROWS_SQL)
def src_mixed_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values under JSON text keys."""
    log = orders_log(spark, sf_dir).withColumn("key", F.to_json("key"))
    return log_rows(dec.decode(log, dec.JsonPlain(KEY_TYPE), dec.Struct()))


@check("src_null_sides", """SELECT CAST(event_id % 3 <> 0 AS INT) AS has_key, CAST(event_id % 4 <> 0 AS INT) AS has_value, count(*) AS n FROM events GROUP BY ALL""")
def src_null_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    log = e.select(
        F.when(n % 3 != 0, F.to_json(F.struct(F.col("user_id").alias("id")))).otherwise("").alias("key"),
        F.when(n % 4 != 0, F.col("props")).alias("value"),
    )
    doc = dec.JsonPlain(T.StructType([T.StructField("k", T.LongType())]))
    df = errors.good(dec.decode(changelog.with_nulls(log), dec.JsonPlain(KEY_TYPE), doc))
    return df.groupBy(
        F.col("key").isNotNull().cast("int").alias("has_key"), F.col("value").isNotNull().cast("int").alias("has_value")
    ).agg(F.count(F.lit(1)).alias("n"))


@check("src_extended_json_id", """SELECT CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR)
  ELSE lpad(CAST(user_id AS VARCHAR), 24, '0') END AS id, count(*) AS n FROM events GROUP BY ALL""")
def src_extended_json_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id").cast("string")
    spelled = (
        F.when(F.col("event_id") % 3 == 0, u)
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('"u'), u, F.lit('"')))
        .otherwise(F.concat(F.lit('{"$oid": "'), F.lpad(u, 24, "0"), F.lit('"}')))
    )
    e = table(spark, sf_dir, "events").select(jsontext.unwrap_extended_id(spelled).alias("id"))
    return e.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@check("jsn_embedded", """SELECT event_id, user_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def jsn_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text inside a field of a JSON record."""
    e = table(spark, sf_dir, "events")
    rec = F.to_json(F.struct(F.struct(F.col("user_id").cast("string").alias("id")).alias("key"), F.col("props").alias("after")))
    outer = e.select("event_id", F.from_json(rec, "key struct<id:string>, after string").alias("r"))
    inner = jsontext.fields(F.col("r.after"))
    return outer.select("event_id", F.col("r.key.id").cast("bigint").alias("id"), inner["k"].cast("bigint").alias("k"))


@check("err_reject_rows", f"""WITH {ORDERS_LOG_SQL} SELECT CASE WHEN k % 17 = 0 THEN 'op is missing' WHEN k % 13 = 0 THEN 'op is not handled: x'
    WHEN k % 11 = 0 AND op <> 'd' THEN 'after is missing or empty' WHEN k % 19 = 0 THEN 'key is missing' ELSE 'good' END AS reason,
  count(*) AS n FROM log9 WHERE op IS NOT NULL GROUP BY 1""")
def err_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with faulty records: good operations and reason codes of the others."""
    from tidefold.operators.cdc_relational import relational_ops

    k, v = F.col("key.id"), F.col("value")
    op = F.when(k % 17 == 0, F.lit(None)).when(k % 13 == 0, F.lit("x")).otherwise(v["op"])
    after = F.when(k % 11 != 0, v["after"])
    faulty = orders_log(spark, sf_dir).withColumn(
        "value", F.when(v.isNotNull(), F.struct(op.alias("op"), v["before"].alias("before"), after.alias("after")))
    ).withColumn("key", F.when(k % 19 != 0, F.col("key")))
    ops = relational_ops(faulty)
    return ops.groupBy(F.coalesce("err", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@check("flt_skip_empty", """SELECT CASE WHEN event_id % 4 <> 0 THEN 'value' ELSE 'key only' END AS kind, count(*) AS n
  FROM events WHERE event_id % 3 <> 0 OR event_id % 4 <> 0 GROUP BY ALL""")
def flt_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    log = table(spark, sf_dir, "events").select(
        F.when(n % 3 != 0, F.col("user_id")).alias("key"), F.when(n % 4 != 0, F.col("props")).alias("value")
    )
    kind = F.when(F.col("value").isNotNull(), "value").otherwise("key only").alias("kind")
    return writemodel.skip_empty(log, delete_on_null=True).groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


# -- types ------------------------------------------------------------------


def typed_values(name: str, sql: str, source: str, fields: list[tuple[T.StructField, object]], opts=TypeOptions()):
    """Register a check that normalises documents built from a table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = T.StructType([f for f, _ in fields])
        row = F.struct(*[make().cast(f.dataType).alias(f.name) for f, make in fields])
        df = table(spark, sf_dir, source).select(row.cast(schema).alias("value"))
        return flat(errors.good(normalise(df, "value", opts)), "value")

    check(name, sql)(query)


def f(name: str, dtype: T.DataType, make, **meta) -> tuple[T.StructField, object]:
    return T.StructField(name, dtype, True, logical(meta.pop("kind", None), **meta) if meta else None), make


KEY = lambda: F.col("o_orderkey")
MS = lambda: F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 1001
EPOCH = "epoch_ms(o_orderdate) + o_orderkey * 1001"
ID = f("id", T.LongType(), KEY)

typed_values("typ_ints", "SELECT o_orderkey AS id, CAST(o_orderkey % 256 - 128 AS INT) AS tiny, CAST(o_orderkey % 65536 - 32768 AS INT) AS small FROM orders",
             "orders", [ID, f("tiny", T.ByteType(), lambda: KEY() % 256 - 128), f("small", T.ShortType(), lambda: KEY() % 65536 - 32768)])
typed_values("typ_passthrough", "SELECT o_orderkey AS id, CAST(o_orderkey AS INT) AS i, CAST(o_orderkey % 2 = 0 AS INT) AS b, o_orderstatus AS s, o_totalprice AS d FROM orders",
             "orders", [ID, f("i", T.IntegerType(), KEY), f("b", T.BooleanType(), lambda: KEY() % 2 == 0),
                        f("s", T.StringType(), lambda: F.col("o_orderstatus")), f("d", T.DoubleType(), lambda: F.col("o_totalprice"))])
typed_values("typ_float", "SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS x FROM orders",
             "orders", [ID, f("x", T.FloatType(), lambda: F.col("o_totalprice"))])
typed_values("typ_bytes", "SELECT o_orderkey AS id, lower(hex(encode(o_orderpriority))) AS raw FROM orders",
             "orders", [ID, f("raw", T.BinaryType(), lambda: F.col("o_orderpriority"))])
typed_values("typ_decimal", "SELECT o_orderkey AS id, CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(20, 2)) / 100 AS DOUBLE) AS price FROM orders",
             "orders", [ID, f("price", T.DecimalType(20, 2), lambda: cents("o_totalprice").cast("decimal(20,2)") / 100)], TypeOptions(legacy_decimal=True))


@check("typ_decimal_exact", """SELECT o_orderkey AS id, CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS VARCHAR) AS price FROM orders""")
def typ_decimal_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals as they are, unless the older form is asked for."""
    price = (cents("o_totalprice").cast("decimal(18,0)") * F.lit(decimal.Decimal("0.01"))).cast("decimal(20,2)")
    df = table(spark, sf_dir, "orders").select(F.struct(KEY().alias("id"), price.alias("price")).alias("value"))
    out = dec.Struct()(df, "value")
    assert out.schema["value"].dataType["price"].dataType == T.DecimalType(20, 2)
    return out.select("value.id", F.col("value.price").cast("string").alias("price"))


typed_values("typ_time", "SELECT o_orderkey AS id, o_orderkey * 5501 % 86400000 AS t FROM orders",
             "orders", [ID, f("t", T.LongType(), lambda: KEY() * 5501 % 86400000, kind="time")])
typed_values("typ_timestamp", f"SELECT o_orderkey AS id, {EPOCH} AS t FROM orders",
             "orders", [ID, f("t", T.LongType(), MS, kind="timestamp")])
typed_values("typ_epoch_day", "SELECT o_orderkey AS id, CAST(epoch_ms(o_orderdate) // 86400000 AS BIGINT) AS d FROM orders",
             "orders", [ID, f("d", T.IntegerType(), lambda: F.unix_date(F.to_date("o_orderdate")), kind="epoch_day")])
typed_values("typ_local_ms", f"SELECT o_orderkey AS id, {EPOCH} - 28800000 AS t FROM orders",
             "orders", [ID, f("t", T.LongType(), MS, kind="local_ms")])
typed_values("typ_local_us", f"SELECT o_orderkey AS id, {EPOCH} - 28800000 AS t FROM orders",
             "orders", [ID, f("t", T.LongType(), lambda: MS() * 1000 + KEY() % 1000, kind="local_us")])
typed_values("typ_zoned", "SELECT event_id AS id, epoch_us(ts) // 1000 + 3600000 AS t FROM events",
             "events", [f("id", T.LongType(), lambda: F.col("event_id")),
                        f("t", T.StringType(), lambda: F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-01:00'"), kind="zoned")])
typed_values("typ_null_default", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS maybe,
  CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE o_orderstatus END AS dflt, o_orderstatus AS must FROM orders WHERE o_orderkey % 5 <> 0""",
             "orders", [ID, f("maybe", T.StringType(), lambda: F.when(KEY() % 2 == 0, F.col("o_orderstatus")), optional=True),
                        f("dflt", T.StringType(), lambda: F.when(KEY() % 3 != 0, F.col("o_orderstatus")), optional=False, default="none"),
                        f("must", T.StringType(), lambda: F.when(KEY() % 5 != 0, F.col("o_orderstatus")), optional=False)])

POINT = T.StructType([T.StructField("x", T.ShortType()), T.StructField("at", T.LongType(), True, logical("timestamp"))])
point = lambda x: F.struct((KEY() % 100 + x).cast("short").alias("x"), MS().alias("at"))
typed_values("typ_struct", f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 100 AS INT) END AS p_x,
  CASE WHEN o_orderkey % 4 <> 0 THEN {EPOCH} END AS p_at FROM orders""",
             "orders", [ID, f("p", POINT, lambda: F.when(KEY() % 4 != 0, point(0)))])
typed_values("typ_array", f"""SELECT o_orderkey AS id, (o_orderkey % 100)::VARCHAR || ',' || (o_orderkey % 7)::VARCHAR AS nums,
  (o_orderkey % 100)::VARCHAR || ':' || ({EPOCH})::VARCHAR || ',' || (o_orderkey % 100 + 1)::VARCHAR || ':' || ({EPOCH})::VARCHAR AS points FROM orders""",
             "orders", [ID, f("nums", T.ArrayType(T.ByteType()), lambda: F.array(KEY() % 100, KEY() % 7)),
                        f("points", T.ArrayType(POINT), lambda: F.array(point(0), point(1)))])
typed_values("typ_map", f"""SELECT o_orderkey AS id, 'a=' || (o_orderkey % 100)::VARCHAR || ',b=' || (o_orderkey % 7)::VARCHAR AS nums,
  'p=' || (o_orderkey % 100)::VARCHAR || ':' || ({EPOCH})::VARCHAR AS points FROM orders""",
             "orders", [ID, f("nums", T.MapType(T.StringType(), T.ShortType()), lambda: F.create_map(F.lit("a"), KEY() % 100, F.lit("b"), KEY() % 7)),
                        f("points", T.MapType(T.StringType(), POINT), lambda: F.create_map(F.lit("p"), point(0)))])


@check("typ_null_container", """SELECT CAST(o_orderkey % 2 = 0 AS INT) AS no_struct, CAST(o_orderkey % 3 = 0 AS INT) AS no_array,
  CAST(o_orderkey % 5 = 0 AS INT) AS no_map, count(*) AS n FROM orders GROUP BY ALL""")
def typ_null_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null container stays null and does not become an empty one."""
    k = KEY()
    row = F.struct(
        F.when(k % 2 != 0, point(0)).cast(POINT).alias("s"),
        F.when(k % 3 != 0, F.array(point(0))).cast(T.ArrayType(POINT)).alias("a"),
        F.when(k % 5 != 0, F.create_map(F.lit("p"), point(0))).cast(T.MapType(T.StringType(), POINT)).alias("m"),
    )
    df = normalise(table(spark, sf_dir, "orders").select(row.alias("value")))
    none = lambda c: F.col(f"value.{c}").isNull().cast("int")
    return df.groupBy(none("s").alias("no_struct"), none("a").alias("no_array"), none("m").alias("no_map")).agg(
        F.count(F.lit(1)).alias("n")
    )


# -- identity ---------------------------------------------------------------


def docs_sql(columns: str) -> str:
    return f"WITH {DOCS_SQL} SELECT {columns} FROM docs"


def id_rows(spark: SparkSession, sf_dir: str, name: str, matcher=None) -> DataFrame:
    docs = order_documents(spark, sf_dir)
    id_col, errs = ids.strategy(name, matcher)(docs)
    return errors.good(errors.add_error(docs, errors.first_error(*errs))).select(F.col("offset").alias("off"), id_col.alias("id"))


@check("id_adder", "SELECT o_orderkey AS \"offset\", 'shop.orders#' || (o_orderkey % 4)::VARCHAR || '#' || o_orderkey::VARCHAR AS _id, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 3 = 0")
def id_adder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values get the id, absent values stay absent."""
    k = F.col("o_orderkey")
    log = table(spark, sf_dir, "orders").select(
        F.lit("shop.orders").alias("topic"), (k % 4).alias("partition"), k.alias("offset"),
        F.when(k % 3 != 0, F.struct(F.col("o_orderstatus").alias("status"))).alias("value"),
    )
    return flat(ids.add_id(log, ids.log_position), "offset", "value")


@check("id_oid")
def id_oid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "random_object_id")


@check("id_uuid")
def id_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "uuid")


@check("id_oid_replayable", docs_sql("_id AS off, substr(sha256('shop.documents#' || part::VARCHAR || '#' || _id::VARCHAR), 1, 24) AS id"))
def id_oid_replayable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "object_id")


@check("id_log_position", docs_sql("_id AS off, 'shop.documents#' || part::VARCHAR || '#' || _id::VARCHAR AS id"))
def id_log_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "log_position")


@check("id_full_key", docs_sql("""_id AS off, '{"_id":' || _id::VARCHAR || ',"buyer":{"cust":' || customer__id::VARCHAR || ',"segment":"' || customer_segment ||
  '"},"origin":{"name":"' || customer_nation_name || '","segment":"' || customer_segment || '"},"region":"' || customer_nation_region || '"}' AS id"""))
def id_full_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "full_key")


@check("id_partial_key", docs_sql("""_id AS off, '{"_id":' || _id::VARCHAR || ',"buyer":{"cust":' || customer__id::VARCHAR || '}}' AS id"""))
def id_partial_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "partial_key", prj.Blacklist.of("region,origin,buyer.segment"))


@check("id_partial_value", docs_sql("""_id AS off, '{"_id":' || _id::VARCHAR || ',"customer":{"name":"' || customer_name || '"},"status":"' || status || '"}' AS id"""))
def id_partial_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "partial_value", prj.Whitelist.of("status,customer.name"))


@check("id_provided_key", docs_sql("_id AS off, _id AS id"))
def id_provided_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_rows(spark, sf_dir, "provided_in_key")


@check("id_provided_value", "SELECT o_orderkey AS off, o_custkey AS id FROM orders WHERE o_orderkey % 3 <> 0")
def id_provided_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without `_id` are bad records."""
    k = F.col("o_orderkey")
    log = table(spark, sf_dir, "orders").select(
        k.alias("off"), F.struct(F.when(k % 3 != 0, F.col("o_custkey")).alias("_id")).alias("value")
    )
    id_col, errs = ids.provided_in_value(log)
    return errors.good(errors.add_error(log, errors.first_error(*errs))).select("off", id_col.alias("id"))


# -- routing ----------------------------------------------------------------

TOPIC = "CASE o_orderkey % 4 WHEN 0 THEN 'eu7-stock-all' WHEN 1 THEN 'shop.public.orders' WHEN 2 THEN 'shop.items' ELSE 'other' END"


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    topic = F.when(k % 4 == 0, "eu7-stock-all").when(k % 4 == 1, "shop.public.orders").when(k % 4 == 2, "shop.items").otherwise("other")
    return table(spark, sf_dir, "orders").select(topic.alias("topic"), k.alias("offset"), F.lit(0).alias("partition"))


def route_counts(df: DataFrame, col: str = "target") -> DataFrame:
    return df.groupBy("topic", col).agg(F.count(F.lit(1)).alias("n"))


def routed(case: str) -> str:
    return f"SELECT topic, {case} AS target, count(*) AS n FROM (SELECT {TOPIC} AS topic FROM orders) GROUP BY ALL"


ROUTES = {"shop.items": "items", "shop.public.orders": "orders"}


@check("route_mapping", routed("CASE topic WHEN 'shop.items' THEN 'items' WHEN 'shop.public.orders' THEN 'orders' ELSE topic END"))
def route_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(rte.route(topics(spark, sf_dir), ROUTES))


@check("route_default", routed("CASE topic WHEN 'shop.items' THEN 'items' ELSE 'rest' END"))
def route_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(rte.route(topics(spark, sf_dir), {"shop.items": "items"}, "rest"))


@check("route_topic_fallback", routed("topic"))
def route_topic_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(rte.route(topics(spark, sf_dir), {"other": ""}))


@check("route_namespace", f"SELECT topic, 'dw.' || topic AS doc_name, 'cat::dw.' || topic AS row_name, count(*) AS n FROM (SELECT {TOPIC} AS topic FROM orders) GROUP BY ALL")
def route_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rte.route(topics(spark, sf_dir), {})
    doc, row = rte.namespace(F.col("target"), "dw"), rte.namespace(F.col("target"), "dw", "cat")
    return df.groupBy("topic", doc.alias("doc_name"), row.alias("row_name")).agg(F.count(F.lit(1)).alias("n"))


@check("route_regex", routed("CASE topic WHEN 'eu7-stock-all' THEN 'stock_all' WHEN 'shop.public.orders' THEN 'shop_public_orders' ELSE topic END"))
def route_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(r"([^.-]+)-stock-(\w+)", "stock_$2"), (r"([^.]+)\.([^.]+)\.([^.]+)", "$1_$2_$3")]
    return route_counts(rte.route(topics(spark, sf_dir), {}, "", rules))


@check("batch_numbering", f"""SELECT target, batch, count(*) AS n, min(off) AS first, max(off) AS last FROM (
  SELECT topic AS target, off, (row_number() OVER (PARTITION BY topic ORDER BY off) - 1) // 700 AS batch
  FROM (SELECT {TOPIC} AS topic, o_orderkey AS off FROM orders)) GROUP BY ALL""")
def batch_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rte.number_batches(rte.route(topics(spark, sf_dir), {}), 700, width=1000)
    return df.groupBy("target", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )
