"""Folds, merges, tables, streams and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.changes import USER_COLUMNS, USER_ROWS_SQL, document, typed_partial
from checks.logs import (
    ORDER_IMAGE, ORDERS_FINAL_SQL, ORDERS_LOG_SQL, PATCH_ROWS_SQL, as_text, envelopes, orders_log, patch_log,
)
from checks.support import cents, check, table
from tidefold.functions import jsontext
from tidefold.model import DELETE, LOG_POSITION, REPLACE
from tidefold.operators import (
    audit, cdc_document as cdoc, cdc_relational as crel, errors, fold, fold_nested, merge, scan,
    writemodel as wm,
)
from tidefold.plans.settings import Settings
from tidefold.sinks.bucket_table import BucketTable
from tidefold.sinks.folders import shared_folder
from tidefold.sources import changelog, decode as dec
from tidefold.streaming import apply as st
from tidefold.streaming.sink import ConfiguredSink

FINAL = f"WITH final AS ({ORDERS_FINAL_SQL}) "


def fold_orders(log: DataFrame) -> DataFrame:
    return fold.fold_latest(errors.good(crel.relational_ops(log, pk_in_id=False)))


def state(rows: DataFrame) -> DataFrame:
    return rows.select("doc.id", "doc.status", "doc.cents")


def no_orders(delta: DataFrame) -> DataFrame:
    return delta.select("k", "doc").limit(0)


# -- folds ------------------------------------------------------------------


@check("fold_lww", ORDERS_FINAL_SQL)
def fold_lww(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(fold_orders(orders_log(spark, sf_dir)).filter(F.col("op") != DELETE))


@check("fold_patches", f"WITH {PATCH_ROWS_SQL} SELECT user_id, f, v, last_id * 2 AS last_off FROM patch_state WHERE act = 'set'")
def fold_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = fold.fold_images(document(spark, sf_dir))
    return live.select(
        F.col("k").cast("bigint").alias("user_id"), F.col("name").alias("f"), F.col("value").alias("v"),
        F.col("ord.offset").alias("last_off"),
    )


@check("fold_partial_rows", USER_ROWS_SQL)
def fold_partial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = typed_partial(document(spark, sf_dir, "row"), USER_COLUMNS)
    folded = fold.fold_columns(ops).filter(F.col("reset") == REPLACE)
    return folded.select(
        F.col("k").cast("bigint").alias("user_id"), *[F.col(f"cols.{c}.v").alias(c) for c in USER_COLUMNS]
    )


NESTED_SQL = """
WITH ev AS (SELECT user_id, event_id AS o, event_type AS t, CAST(round(value * 100) AS BIGINT) AS c, event_id % 5 AS m FROM events),
marks AS (
  SELECT user_id, '' AS p, o, t = 'signup' AS up FROM ev WHERE t = 'signup' OR (t = 'error' AND o % 4 = 0)
  UNION ALL SELECT user_id, 'd.' || x.f, o, true FROM ev, (VALUES ('v'), ('t')) x(f) WHERE t IN ('view', 'click')
  UNION ALL SELECT user_id, 'd.p.x' || m::VARCHAR, o, true FROM ev WHERE t = 'purchase' AND m <> 0
  UNION ALL SELECT user_id, 'd.p', o, true FROM ev WHERE t = 'purchase' AND m = 0
  UNION ALL SELECT user_id, 'd', o, false FROM ev WHERE t = 'error' AND o % 4 = 1
  UNION ALL SELECT user_id, 'd.v', o, false FROM ev WHERE t = 'error' AND o % 4 IN (2, 3)),
tops AS (SELECT user_id, p, max(o) AS mark, arg_max(up, o) AS up FROM marks GROUP BY user_id, p),
leaves AS (
  SELECT user_id, '_id' AS q, o, user_id::VARCHAR AS v FROM ev WHERE t = 'signup'
  UNION ALL SELECT user_id, 'n', o, o::VARCHAR FROM ev WHERE t = 'signup'
  UNION ALL SELECT user_id, 'd.v', o, c::VARCHAR FROM ev WHERE t IN ('signup', 'view', 'click')
  UNION ALL SELECT user_id, 'd.t', o, '"' || t || '"' FROM ev WHERE t IN ('view', 'click')
  UNION ALL SELECT user_id, 'd.p.x' || m::VARCHAR, o, o::VARCHAR FROM ev WHERE t = 'purchase' AND m <> 0
  UNION ALL SELECT user_id, 'd.p.base', o, o::VARCHAR FROM ev WHERE t = 'purchase' AND m = 0),
last AS (SELECT user_id, q, arg_max(v, o) AS v, max(o) AS o FROM leaves GROUP BY user_id, q)
SELECT l.user_id, q AS path, v AS value FROM last l JOIN tops r ON r.user_id = l.user_id AND r.p = '' AND r.up
WHERE NOT EXISTS (SELECT 1 FROM tops t WHERE t.user_id = l.user_id AND t.mark > l.o
  AND (t.p = '' OR t.p = l.q OR l.q LIKE t.p || '.%'))"""


def nested_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches of nested fields by dotted paths."""
    e = table(spark, sf_dir, "events")
    kind, n, v = F.col("event_type"), F.col("event_id"), cents("value")
    js = lambda *cols: F.to_json(F.struct(*cols))
    path = F.concat(F.lit('{"$set":{"d.p.x'), (n % 5).cast("string"), F.lit('":'), n.cast("string"), F.lit("}}"))
    unset = lambda p: F.lit(f'{{"$unset":{{"{p}":true}}}}')
    patch = (
        F.when(kind == "signup", js(F.col("user_id").alias("_id"), n.alias("n"), F.struct(v.alias("v")).alias("d")))
        .when(kind.isin("view", "click"), js(F.struct(v.alias("d.v"), kind.alias("d.t")).alias("$set")))
        .when((kind == "purchase") & (n % 5 == 0), js(F.struct(F.struct(n.alias("base")).alias("d.p")).alias("$set")))
        .when(kind == "purchase", path)
        .when(n % 4 == 1, unset("d"))
        .otherwise(unset("d.v"))
    )
    op = F.when((kind == "error") & (n % 4 == 0), "d").otherwise("u")
    log = e.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), n.alias("offset"),
        F.struct(F.col("user_id").cast("string").alias("id")).alias("key"),
        F.struct(op.alias("op"), F.lit(None).cast("string").alias("after"), patch.alias("patch")).alias("value"),
    )
    return errors.good(fold_nested.check_paths(cdoc.document_ops(log)))


@check("fold_nested_patches", NESTED_SQL)
def fold_nested_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = fold_nested.fold_paths(nested_ops(spark, sf_dir))
    return live.select(F.col("k").cast("bigint").alias("user_id"), "path", "value")


@check("merge_nested_patches", NESTED_SQL)
def merge_nested_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half as documents of a target, the newer half merged into them."""
    ops = nested_ops(spark, sf_dir)
    half = ops.agg(F.max("ord.offset")).first()[0] // 2
    older, newer = ops.filter(F.col("ord.offset") < half), ops.filter(F.col("ord.offset") >= half)
    older, newer = fold_nested.fold_writes(older), fold_nested.fold_writes(newer)
    empty = older.select("k", F.lit("").alias("doc")).limit(0)
    target = fold_nested.merge_paths(empty, older)
    merged = errors.good(fold_nested.merge_paths(target, newer))
    leaf = merged.select("k", F.explode(jsontext.fields(F.col("doc"))).alias("path", "text")).select(
        "k", F.explode(fold_nested.leaves("path", "text")).alias("l")
    )
    # documents keep emptied parents, which have no leaf
    return leaf.filter("l.value <> '{}'").select(F.col("k").cast("bigint").alias("user_id"), "l.path", "l.value")


@check("order_across_topics", """SELECT event_id % 3 AS part, event_id, row_number() OVER (ORDER BY mono, event_id % 3, event_id) AS place FROM (
  SELECT event_id, max(epoch_us(ts) - (event_id % 7) * 600000000) OVER (PARTITION BY event_id % 3 ORDER BY event_id) AS mono FROM events)""")
def order_across_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several partitions whose times run backwards now and then."""
    n = F.col("event_id")
    ts = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - (n % 7) * 600_000_000)
    log = table(spark, sf_dir, "events").select(
        F.lit("t").alias("topic"), (n % 3).alias("partition"), n.alias("offset"), ts.alias("timestamp")
    )
    ordered = scan.order_across_topics(log, width=500).withColumn("hour", F.date_trunc("hour", "ord.time"))
    # places by hour blocks: no window over all rows
    hours = ordered.withColumn("block", F.unix_seconds("hour") * 1)
    numbered = scan.number_rows(hours, ["topic"], ["block", "ord"], width=3600)
    return numbered.select(F.col("partition").alias("part"), F.col("offset").alias("event_id"), (F.col("rn") + 1).alias("place"))


# -- merges -----------------------------------------------------------------


def first_half(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inserts and half of the changes; the rest."""
    early = F.col("offset") % 8 < F.when(F.col("key.id") % 2 == 0, 2).otherwise(1)
    return log.filter(early), log.filter(~early)


@check("merge_snapshot", ORDERS_FINAL_SQL)
def merge_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = first_half(orders_log(spark, sf_dir))
    first, second = fold_orders(early), fold_orders(late)
    target = merge.merge_latest(no_orders(first), first)
    return state(merge.merge_latest(target, second))


@check("merge_patches", f"WITH {PATCH_ROWS_SQL} SELECT user_id, f, v FROM patch_state WHERE act = 'set'")
def merge_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents of the older half take the patches of the newer half."""
    ops = document(spark, sf_dir)
    half = ops.agg(F.max("ord.offset")).first()[0] // 2
    older, newer = fold.fold_fields(ops.filter(F.col("offset") < half)), fold.fold_fields(ops.filter(F.col("offset") >= half))
    empty = older.select("k", F.lit("").alias("doc")).limit(0)
    docs = merge.merge_fields(merge.merge_fields(empty, older), newer)
    return docs.select(F.col("k").cast("bigint").alias("user_id"), F.explode(jsontext.fields(F.col("doc"))).alias("f", "v"))


@check("merge_idempotent", ORDERS_FINAL_SQL)
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records are delivered twice; old ones must not bring deleted rows back."""
    log = orders_log(spark, sf_dir)
    # in each partition, offsets below the half come first
    half = log.agg(F.max("offset")).first()[0] // 2
    early, late = log.filter(F.col("offset") <= half), log.filter(F.col("offset") > half)
    first = fold_orders(early)
    target = merge.merge_latest(no_orders(first), first)
    again = merge.after_offsets(early.unionByName(late).unionByName(early), merge.last_offsets(early), 4)
    second = merge.merge_latest(target, fold_orders(again))
    everything = early.unionByName(late)
    # the second way, for more topic partitions than are broadcast
    third = merge.after_offsets(everything, merge.last_offsets(everything), merge.BROADCAST_ROWS + 1)
    return state(merge.merge_latest(second, fold_orders(third)))


@check("merge_delete_missing", "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 7 <> 0")
def merge_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of rows the target does not hold change nothing."""
    log = orders_log(spark, sf_dir)
    inserts = fold_orders(log.filter("offset % 8 = 0 AND key.id % 7 <> 0"))
    deletes = fold_orders(log.filter("value.op = 'd'"))
    return state(merge.merge_latest(merge.merge_latest(no_orders(inserts), inserts), deletes))


# -- tables -----------------------------------------------------------------

def latest_into(target: DataFrame | None, delta: DataFrame) -> DataFrame:
    target = target if target is not None else delta.select("k", "doc").limit(0)
    return merge.merge_latest(target, delta)


def columns_into(target: DataFrame | None, delta: DataFrame) -> DataFrame:
    if target is None:
        doc = F.struct(*[F.col(f"cols.{c}.v").alias(c) for c in delta.schema["cols"].dataType.names])
        target = delta.select("k", doc.alias("doc")).limit(0)
    return merge.merge_columns(target, delta)


def fields_into(target: DataFrame | None, delta: DataFrame) -> DataFrame:
    target = target if target is not None else delta.select("k", F.lit("").alias("doc")).limit(0)
    return merge.merge_fields(target, delta)


def fold_rows(log: DataFrame) -> DataFrame:
    return fold.fold_columns(errors.good(crel.relational_ops(log, "row")), mixed_upserts=True)


def fold_users(log: DataFrame) -> DataFrame:
    return fold.fold_fields(errors.good(cdoc.document_ops(log)))


def new_table(spark: SparkSession, name: str, buckets: int = 15) -> BucketTable:
    return BucketTable(spark, shared_folder(spark, name), ("k",), buckets)


@check("apply_doc_collection", ORDERS_FINAL_SQL)
def apply_doc_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text log, decoded, folded and merged into a stored collection in two batches."""
    t = new_table(spark, "orders")
    log = as_text(orders_log(spark, sf_dir))
    envelope = T.StructType.fromDDL(f"op string, before {ORDER_IMAGE}, after {ORDER_IMAGE}")
    key, value = dec.JsonPlain(T.StructType.fromDDL("id bigint")), dec.JsonPlain(envelope)
    early, late = first_half(errors.good(dec.decode(log, key, value)))
    st.apply_batch(t, early, fold_orders, latest_into, 0, fence=False)
    st.apply_batch(t, late, fold_orders, latest_into, 1, fence=False)
    return state(t.read())


@check("apply_row_table", ORDERS_FINAL_SQL)
def apply_row_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = new_table(spark, "rows")
    early, late = first_half(orders_log(spark, sf_dir))
    st.apply_batch(t, early, fold_rows, columns_into, 0, fence=False)
    st.apply_batch(t, late, fold_rows, columns_into, 1, fence=False)
    return state(t.read())


@check("apply_multi_target", FINAL + f""", {PATCH_ROWS_SQL.strip()} SELECT 'even' AS target, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total FROM final WHERE id % 2 = 0
  UNION ALL SELECT 'odd', count(*), CAST(sum(cents) AS BIGINT) FROM final WHERE id % 2 = 1""")
def apply_multi_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured sink takes a log of JSON text with four topics into two tables."""
    log = as_text(orders_log(spark, sf_dir)).withColumn("topic", F.concat(F.lit("shop.p"), F.col("partition")))
    settings = Settings({
        "cdc.handler": "postgres", "database": "dw", "route": "odd", "route.shop.p0": "even", "route.shop.p2": "even",
    })
    envelope = T.StructType.fromDDL(f"op string, before {ORDER_IMAGE}, after {ORDER_IMAGE}")
    sink = ConfiguredSink(
        spark, settings, shared_folder(spark, "sink"),
        key_decoder=dec.JsonPlain(T.StructType.fromDDL("id bigint")), value_decoder=dec.JsonPlain(envelope),
    )
    sink.apply(log, 0)
    totals = lambda n: sink.table(n).read().agg(
        F.lit(n).alias("target"), F.count(F.lit(1)).alias("n"), F.sum("doc.cents").alias("total")
    )
    return totals("even").unionByName(totals("odd"))


@check("tbl_bucketed_pk", FINAL + "SELECT count(*) AS n, count(DISTINCT id) AS keys, CAST(15 AS BIGINT) AS buckets, CAST(0 AS BIGINT) AS split_keys FROM final")
def tbl_bucketed_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key is stored once and in one of fifteen buckets."""
    t = new_table(spark, "bucketed")
    st.apply_batch(t, orders_log(spark, sf_dir), fold_orders, latest_into, 0)
    rows = t.read(with_bucket=True)
    split = audit.duplicate_keys(rows, ["k"]).agg(F.count(F.lit(1)).alias("split_keys"))
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc.id").alias("keys"), F.count_distinct("_bucket").alias("buckets")
    )
    # both sides are one row
    return counts.withColumn("_one", F.lit(1)).join(split.withColumn("_one", F.lit(1)), "_one").drop("_one")


@check("tbl_cast_copy", """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS INT) AS cust, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders""")
def tbl_cast_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table copied into another one with casts; the swap table held other rows before."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", cents("o_totalprice").alias("cents"))
    source, swap = (BucketTable(spark, shared_folder(spark, n), (k,), 4) for n, k in (("a", "o_orderkey"), ("swap", "id")))
    cast = lambda df: df.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("int").alias("cust"), "cents"
    )
    source.overwrite(o)
    swap.overwrite(cast(o.withColumn("o_custkey", F.col("o_custkey") + 1)))
    swap.truncate()
    swap.overwrite(cast(source.read()))
    swap.expire()
    return swap.read()


@check("tbl_double_write_keys", """SELECT 'by_user' AS tbl, user_id::VARCHAR AS pk, max(event_id) AS last_id, CAST(1 AS BIGINT) AS n FROM events GROUP BY user_id
  UNION ALL SELECT 'by_type_day', event_type || '/' || (epoch_us(ts) // 86400000000)::VARCHAR, max(event_id), CAST(1 AS BIGINT) FROM events GROUP BY 2""")
def tbl_double_write_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log into two tables under different primary keys."""
    e = table(spark, sf_dir, "events")
    day = F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(86_400_000_000)).cast("string")
    value = F.struct("user_id", F.concat_ws("/", "event_type", day).alias("type_day"), "event_id")
    log = e.select(
        F.lit("shop.events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        value.alias("key"), value.alias("value"),
    ).persist()

    def fold_by(*keys: str):
        return lambda df: fold.fold_columns(errors.good(wm.write_ops(df, wm.row_upsert(list(keys)))))

    out = []
    for name, pk in (("by_user", "user_id"), ("by_type_day", "type_day")):
        t = new_table(spark, name)
        st.apply_batch(t, log, fold_by(pk), columns_into, 0)
        rows = t.read()
        out.append(
            rows.groupBy(F.col(f"k.{pk}").cast("string").alias("pk")).agg(
                F.max("doc.event_id").alias("last_id"), F.count(F.lit(1)).alias("n")
            ).select(F.lit(name).alias("tbl"), "pk", "last_id", "n")
        )
    log.unpersist()
    return out[0].unionByName(out[1])


# -- streams ----------------------------------------------------------------


def orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders file as a stream of change records."""
    schema = table(spark, sf_dir, "orders").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    k = F.col("o_orderkey")
    steps = F.filter(
        F.array(F.lit(0), F.when(k % 3 == 0, 1), F.when(k % 7 == 0, 2), F.when(k % 7 == 0, 3), F.when(k % 21 == 0, 4)),
        lambda x: x.isNotNull(),
    )
    rows = raw.select(
        k.alias("k"), F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents"),
        F.col("o_orderdate").cast("timestamp").alias("day"), F.explode(steps).alias("seq"),
    )
    return envelopes(rows)


@check("str_apply_available_now", ORDERS_FINAL_SQL)
def str_apply_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = new_table(spark, "streamed")
    each = lambda df, batch: st.apply_batch(t, df, fold_orders, latest_into, batch)
    st.apply_stream(orders_stream(spark, sf_dir), each, shared_folder(spark, "checkpoint")).awaitTermination()
    return state(t.read())


def in_pieces(spark: SparkSession, log: DataFrame, pieces: int):
    """A log that grows piece by piece in offset order: its path, and one call per piece."""
    path = shared_folder(spark, "log")
    top = log.agg(F.max("offset")).first()[0] + 1
    cut = lambda i: top * i // pieces

    def grow(i: int) -> None:
        log.filter((F.col("offset") >= cut(i)) & (F.col("offset") < cut(i + 1))).write.mode("append").parquet(path)

    return path, grow


@check("str_restart_no_dup", f"WITH {PATCH_ROWS_SQL} SELECT user_id, f, v FROM patch_state WHERE act = 'set'")
def str_restart_no_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query stopped and restarted from its checkpoint, then once more from none at all."""
    log = patch_log(spark, sf_dir)
    path, grow = in_pieces(spark, log, 3)
    t, checkpoint = new_table(spark, "users", 8), shared_folder(spark, "checkpoint")
    stream = lambda: changelog.stream_log(spark, "parquet", path, log.schema)
    run = lambda at: st.apply_stream(
        stream(), lambda df, batch: st.apply_batch(t, df, fold_users, fields_into, batch, source=at), at
    ).awaitTermination()
    for i in range(3):
        grow(i)
        run(checkpoint)
    # a new checkpoint counts from 0 and delivers the whole log again
    run(shared_folder(spark, "checkpoint"))
    docs = t.read()
    return docs.select(F.col("k").cast("bigint").alias("user_id"), F.explode(jsontext.fields(F.col("doc"))).alias("f", "v"))


@check("str_late_ignored", ORDERS_FINAL_SQL)
def str_late_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records at or below the applied offsets arrive late, altered, and are ignored."""
    log = orders_log(spark, sf_dir)
    path = shared_folder(spark, "log")
    t, checkpoint = new_table(spark, "orders"), shared_folder(spark, "checkpoint")
    run = lambda: st.apply_stream(
        changelog.stream_log(spark, "parquet", path, log.schema), lambda df, batch: st.apply_batch(t, df, fold_orders, latest_into, batch), checkpoint
    ).awaitTermination()
    log.write.parquet(path)
    run()
    v = F.col("value")
    late = F.struct(v["op"].alias("op"), v["before"].alias("before"), F.struct(
        v["after"]["id"].alias("id"), F.lit("LATE").alias("status"), v["after"]["cents"].alias("cents")).alias("after"))
    log.filter("value.op IN ('c', 'r')").withColumn("value", late).write.mode("append").parquet(path)
    run()
    return state(t.read())


@check("str_dedup_offsets", f"WITH {ORDERS_LOG_SQL} SELECT topic, part, count(*) AS n, CAST(sum(off) AS BIGINT) AS total FROM log9 GROUP BY ALL")
def str_dedup_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is delivered twice and passes once."""
    path, out, state_path = (shared_folder(spark, n) for n in ("log", "once", "checkpoint"))
    log = orders_log(spark, sf_dir)
    log.unionByName(log).write.parquet(path)
    once = st.drop_repeated(changelog.stream_log(spark, "parquet", path, log.schema))
    once.select(*LOG_POSITION).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", state_path
    ).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(out)
    return rows.groupBy("topic", F.col("partition").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("total")
    )


@check("str_ingest_rate", """SELECT epoch_ms(time_bucket(INTERVAL 1 DAY, ts)) AS start_ms, count(*) AS n, count(*) / 86400 AS per_sec FROM events GROUP BY 1""")
def str_ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of a stream per day of event time, over several micro-batches in order of time, and a heartbeat."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    path, out, checkpoint = (shared_folder(spark, n) for n in ("events", "rate", "checkpoint"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 3
    for i in range(4):
        after, upto = first + step * i, first + step * (i + 1)
        part = events.filter((F.col("ts") >= after) & (F.col("ts") < upto)) if i < 2 else events.filter(F.col("ts") >= after)
        if i == 3:
            part = spark.createDataFrame([(last + dt.timedelta(days=10),)], events.schema)
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.schema).parquet(path)
        st.append_rates(stream, "ts", "1 day", "1 day", out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(F.unix_millis("start").alias("start_ms"), "n", "per_sec")


# -- audits -----------------------------------------------------------------


def final_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(fold_orders(orders_log(spark, sf_dir)).filter(F.col("op") != DELETE))


@check("qa_target_counts", FINAL + f""", {PATCH_ROWS_SQL.strip()} SELECT 'orders' AS target, count(*) AS n FROM final
  UNION ALL SELECT 'users', count(DISTINCT user_id) FROM patch_state""")
def qa_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = fold.fold_fields(document(spark, sf_dir)).filter(F.col("reset") == REPLACE)
    return audit.target_counts({"orders": final_orders(spark, sf_dir), "users": live})


@check("qa_sample", FINAL + "SELECT * FROM final ORDER BY id LIMIT 5")
def qa_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.sample(final_orders(spark, sf_dir), ["id"])


@check("qa_missing_ids", FINAL + "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT id FROM final)")
def qa_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    produced = orders_log(spark, sf_dir).select("key.id")
    return audit.missing_keys(produced, final_orders(spark, sf_dir), ["id"])


@check("qa_pk_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def qa_pk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("qa_split_keys", """SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_id % 2) > 1""")
def qa_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose events lie in more than one partition of a log that is not keyed by user."""
    ops = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("k"), F.lit("t").alias("topic"), (F.col("event_id") % 2).alias("partition")
    )
    return audit.split_keys(ops).select(F.col("k").alias("user_id"))


@check("qa_ingest_rate", """SELECT epoch_ms(time_bucket(INTERVAL 1 HOUR, ts)) AS start_ms, count(*) AS n, count(*) / 3600 AS per_sec FROM events GROUP BY 1""")
def qa_ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return audit.ingest_rate(e, "ts", "1 hour").select(F.unix_millis("start").alias("start_ms"), "n", "per_sec")
