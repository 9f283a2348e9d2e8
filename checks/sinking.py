"""The configured sink as a user runs it, batch after batch, beside SQL in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from checks.logs import LINE_IMAGE, keyless_log, line_images
from checks.support import cents, check, table
from tidefold.plans.settings import Settings
from tidefold.sinks.folders import shared_folder
from tidefold.sources import decode as dec
from tidefold.streaming.sink import ConfiguredSink


def sink(spark: SparkSession, values: dict, **parts) -> ConfiguredSink:
    return ConfiguredSink(spark, Settings(values), shared_folder(spark, "sink"), buckets=4, **parts)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents"))


def records(df: DataFrame, offset: Column, key: Column, value: Column, topic: str = "t", time: Column | None = None) -> DataFrame:
    """Log records of the rows, one partition per remainder of k."""
    return df.select(
        F.lit(topic).alias("topic"), (F.col("k") % 4).cast("int").alias("partition"), offset.cast("bigint").alias("offset"),
        (time if time is not None else F.lit(None)).cast("timestamp").alias("timestamp"), F.lit("CREATE_TIME").alias("timestamp_type"),
        key.alias("key"), value.alias("value"),
    )


def text(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))


def document_event(op: str, after: Column | None = None, patch: Column | None = None) -> Column:
    body = lambda c, n: (c if c is not None else F.lit(None).cast("string")).alias(n)
    return F.struct(F.lit(op).alias("op"), body(after, "after"), body(patch, "patch"))


def id_text() -> Column:
    return F.struct(F.col("k").cast("string").alias("id"))


@check("sink_patch_refused", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS a,
  CASE WHEN o_orderkey % 3 <> 0 THEN 5 END AS s, CASE WHEN o_orderkey % 3 = 0 THEN 1 END AS sx FROM orders""")
def sink_patch_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch runs through a scalar unless that was removed before; the accepted patch before it stands."""
    o, k = orders(spark, sf_dir), F.col("k")
    new = records(o, k, id_text(), document_event("c", after=text(k.alias("_id"), F.lit(0).alias("a"), F.lit(5).alias("s"))))
    n = 100_000_000
    first = records(o, k + n, id_text(), document_event("u", patch=text(F.struct(F.col("cents").alias("a")).alias("$set"))))
    freed = records(o.filter("k % 3 = 0"), k + 2 * n, id_text(), document_event("u", patch=F.lit('{"$unset":{"s":true}}')))
    last = records(o, k + 3 * n, id_text(), document_event("u", patch=F.lit('{"$set":{"a":-1,"s.x":1}}')))
    s = sink(spark, {"cdc.handler": "document", "on.error": "reject"})
    s.apply(new, 0)
    s.apply(first.unionByName(freed).unionByName(last), 1)
    doc = F.from_json("doc", "_id bigint, a bigint, s string")
    rows = s.table("t").read().select(doc.alias("d"))
    inner = F.get_json_object("d.s", "$.x").cast("int")
    return rows.select(F.col("d._id").alias("id"), "d.a", F.when(inner.isNull(), F.col("d.s").cast("int")).alias("s"), inner.alias("sx"))


@check("sink_topics_one_target", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS status FROM orders""")
def sink_topics_one_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics feed one table: the younger record wins, whatever the offsets."""
    o, k = orders(spark, sf_dir), F.col("k")
    at = lambda second: F.timestamp_seconds(k * 10 + second)
    row = lambda status: F.struct(k.alias("id"), F.lit(status).alias("status"))
    a = records(o, k, F.struct(k.alias("id")), row("A"), "east.orders", at(F.when(k % 2 == 0, 5).otherwise(1)))
    b = records(o, k + 100_000_000, F.struct(k.alias("id")), row("B"), "west.orders", at(F.lit(3)))
    s = sink(spark, {"route.east.orders": "orders", "route.west.orders": "orders", "id.strategy": "full_key"})
    log, half = a.unionByName(b), F.col("key.id") < 5000
    s.apply(log.filter(half), 0)
    s.apply(log.filter(~half), 1)
    return s.table("orders").read().select("doc.id", "doc.status")


@check("sink_nopk_apply", """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag,
  CAST(round(l_extendedprice * 100) AS BIGINT) + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS cents
FROM lineitem WHERE l_orderkey % 5 = 0 OR l_orderkey % 11 <> 0""")
def sink_nopk_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without key: its rows, then the changes of some, matched by their images."""
    image = F.struct(*LINE_IMAGE)
    value = F.struct(F.lit("c").alias("op"), F.lit(None).cast(image_type()).alias("before"), image.alias("after"))
    lines = line_images(spark, sf_dir).withColumn("k", F.col("l_orderkey"))
    none = F.lit(None).cast("struct<id:bigint>")
    new = records(lines, F.col("k") * 8 + F.col("l_linenumber"), none, value, "shop.lines")
    changes = keyless_log(spark, sf_dir)
    changes = changes.select("topic", "partition", (F.col("offset") + 1_000_000_000_000).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
                             F.lit("CREATE_TIME").alias("timestamp_type"), none.alias("key"), "value")
    s = sink(spark, {"cdc.handler": "mysql", "keyless": "true"})
    s.apply(new, 0)
    s.apply(changes, 1)
    return s.rows("shop.lines")


def image_type() -> T.StructType:
    return T.StructType.fromDDL("l_orderkey bigint, l_linenumber int, l_returnflag string, cents bigint")


@check("sink_rdbms_new_column", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'n' || o_orderstatus
  WHEN o_orderkey % 3 = 0 THEN CAST(10000000000 + o_orderkey AS VARCHAR) ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS amount,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS note FROM orders""")
def sink_rdbms_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column appears, another widens from int to bigint to text, over three batches into a row table."""
    o, k = orders(spark, sf_dir), F.col("k")

    def events(df: DataFrame, op: str, n: int, *columns: Column) -> DataFrame:
        image = F.struct(k.alias("id"), *columns)
        value = F.struct(F.lit(op).alias("op"), F.when(F.lit(False), image).alias("before"), image.alias("after"))
        return records(df, k + n * 100_000_000, F.struct(k.alias("id")), value)

    s = sink(spark, {"cdc.handler": "postgres"}, kind="row")
    s.apply(events(o, "c", 0, (k % 1000).cast("int").alias("amount")), 0)
    s.apply(events(o.filter("k % 3 = 0"), "u", 1, (k + 10_000_000_000).alias("amount"), F.col("status").alias("note")), 1)
    s.apply(events(o.filter("k % 7 = 0"), "u", 2, F.concat(F.lit("n"), "status").alias("amount")), 2)
    return s.table("t").read().select("doc.id", "doc.amount", "doc.note")


@check("sink_row_doc_evolve", """SELECT o_orderkey AS _id, CASE WHEN o_orderkey % 5 = 0 THEN 'x' || o_orderkey ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS n,
  CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN o_orderstatus END AS t, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END AS q FROM orders""")
def sink_row_doc_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents into a row table with typed columns, which appear and widen over three batches."""
    o, k = orders(spark, sf_dir), F.col("k")
    n = 100_000_000
    new = records(o, k, id_text(), document_event("c", after=text(k.alias("_id"), F.col("cents").alias("n"))))
    more = F.struct(F.col("status").alias("t"), (k % 4).alias("q"))
    first = records(o.filter("k % 3 = 0"), k + n, id_text(), document_event("u", patch=text(more.alias("$set"))))
    words = records(o.filter("k % 5 = 0"), k + 2 * n, id_text(), document_event("u", patch=text(F.struct(F.concat(F.lit("x"), k).alias("n")).alias("$set"))))
    gone = records(o.filter("k % 7 = 0"), k + 3 * n, id_text(), document_event("u", patch=F.lit('{"$unset":{"t":true}}')))
    s = sink(spark, {"cdc.handler": "document"}, kind="row")
    for batch, log in enumerate((new, first, words.unionByName(gone))):
        s.apply(log, batch)
    return s.table("t").read().select("doc._id", "doc.n", "doc.t", "doc.q")


@check("sink_json_raw_chain", """SELECT '{"id":' || o_orderkey || '}' AS k, o_orderstatus AS name, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cents,
  o_orderkey % 5 AS place, 't-' || (o_orderkey % 4) || '-' || o_orderkey AS position FROM orders""")
def sink_json_raw_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts without a schema through id, projection, renaming and metadata; fields of the second batch are new."""
    o, k = orders(spark, sf_dir), F.col("k")
    inner = F.struct((k % 5).alias("place"), F.lit("hidden").alias("code"))
    value = text(F.col("status").alias("nm"), F.when(k % 3 != 0, F.col("cents")).alias("cents"), F.lit("4711").alias("secret"), inner.alias("at"))
    log = records(o, k, text(k.alias("id")), value)
    s = sink(spark, {
        "id.strategy": "full_key", "processors": "id,value.projection,rename.mapping,log.metadata",
        "value.projection.type": "blacklist", "value.projection.list": "secret,at.code",
        "rename.mapping": '[{"oldName": "value.nm", "newName": "name"}]',
    }, key_decoder=dec.JsonInferred(), value_decoder=dec.JsonInferred())
    # the first batch holds no cents at all
    early = F.col("offset") % 3 == 0
    s.apply(log.filter(early), 0)
    s.fence = False
    s.apply(log.filter(~early), 1)
    rows = s.table("t").read()
    held = rows.schema["doc"].dataType
    assert "secret" not in held.names and held["at"].dataType.names == ["place"]
    return rows.select("k", "doc.name", "doc.cents", "doc.at.place", F.col("doc").getField("topic-partition-offset").alias("position"))
