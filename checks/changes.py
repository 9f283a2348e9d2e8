"""Change events of relational and document sources, and write models of plain records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.logs import (
    LINE_IMAGE, ORDERS_FINAL_SQL, ORDERS_LOG_SQL, PATCH_ROWS_SQL, TURNS_FINAL_SQL, keyless_log, line_images,
    order_documents, orders_log, patch_log, turns_log,
)
from checks.support import cents, check, flat, table
from tidefold.functions import ids, jsontext
from tidefold.model import DELETE, ID, LOG_POSITION, REPLACE, SET
from tidefold.operators import (
    cdc_document as cdoc, cdc_relational as crel, errors, evolve, fold, keyless, merge, writemodel as wm,
)
from tidefold.plans.settings import Settings
from tidefold.plans.target_plan import Registry, TargetPlan
from tidefold.sources import decode as dec

def relational(spark: SparkSession, sf_dir: str, target: str = "document") -> DataFrame:
    return errors.good(crel.relational_ops(orders_log(spark, sf_dir), target))


def op_rows(ops: DataFrame, op: str) -> DataFrame:
    return ops.filter(F.col("op") == op)


# -- relational sources -----------------------------------------------------


@check("cdc_op_counts", f"WITH {ORDERS_LOG_SQL} SELECT op, count(*) AS n FROM log9 WHERE op IS NOT NULL GROUP BY op")
def cdc_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = crel.skip_tombstones(orders_log(spark, sf_dir))
    ops = errors.good(crel.check_op(log, crel.op_code(log), crel.DOCUMENT_TARGET.keys()))
    return ops.groupBy("value.op").agg(F.count(F.lit(1)).alias("n"))


@check("cdc_rdbms_tombstone", f"WITH {ORDERS_LOG_SQL} SELECT part, count(*) AS n, max(off) AS last FROM log9 WHERE op IS NOT NULL GROUP BY part")
def cdc_rdbms_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = relational(spark, sf_dir)
    return ops.groupBy(F.col("partition").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last"))


def writes_sql(codes: str) -> str:
    return f"WITH {ORDERS_LOG_SQL} SELECT off, k AS _id_id, after_status AS status, after_cents AS cents FROM log9 WHERE op IN ({codes})"


def of_events(ops: DataFrame, log: DataFrame, *codes: str) -> DataFrame:
    """The operations that events of the given codes were turned into."""
    events = log.select(*LOG_POSITION, F.col("value.op").alias("code")).filter(F.col("code").isin(*codes))
    return ops.join(events, LOG_POSITION, "left_semi")


def writes_of(*codes: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = orders_log(spark, sf_dir)
        ops = of_events(errors.good(crel.relational_ops(log)), log, *codes)
        return flat(op_rows(ops, REPLACE).withColumnRenamed("offset", "off"), "off", "doc")

    return query


check("cdc_rdbms_insert", writes_sql("'c', 'r'"))(writes_of("c", "r"))
check("cdc_rdbms_update", writes_sql("'u'"))(writes_of("u"))


@check("cdc_rdbms_delete", f"WITH {ORDERS_LOG_SQL} SELECT off, k AS id FROM log9 WHERE op = 'd'")
def cdc_rdbms_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op_rows(relational(spark, sf_dir), DELETE).select(F.col("offset").alias("off"), "k.id")


@check("cdc_compound_pk", f"WITH {TURNS_FINAL_SQL} SELECT conv_id, turn, role, chars FROM turns")
def cdc_compound_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = errors.good(crel.relational_ops(turns_log(spark, sf_dir)))
    last = fold.fold_latest(ops).filter(F.col("op") != DELETE)
    return last.select("k.conv_id", "k.turn", "doc.role", "doc.chars")


@check("cdc_pk_in_id", f"WITH {TURNS_FINAL_SQL} SELECT conv_id AS _id_conv_id, turn AS _id_turn, role, chars FROM turns")
def cdc_pk_in_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaves of the stored documents: key columns live in `_id` only."""
    ops = errors.good(crel.relational_ops(turns_log(spark, sf_dir)))
    return flat(fold.fold_latest(ops).filter(F.col("op") != DELETE), "doc")


@check("cdc_nopk_insert")
def cdc_nopk_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as an insert of a table without key: documents under random ids."""
    li = line_images(spark, sf_dir)
    value = F.struct(F.lit("c").alias("op"), F.struct(*LINE_IMAGE).alias("after"))
    log = li.select(
        F.lit("shop.lines").alias("topic"), F.lit(0).alias("partition"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("offset"), value.alias("value"),
    )
    random_id = F.substring(F.sha2(F.uuid(), 256), 1, 24)
    return flat(crel.keyless_insert_id(log, random_id), "doc")


@check("cdc_nopk_before_match", """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag,
  CAST(round(l_extendedprice * 100) AS BIGINT) + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS cents
  FROM lineitem WHERE l_orderkey % 5 = 0 OR l_orderkey % 11 <> 0""")
def cdc_nopk_before_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = keyless.image_changes(keyless_log(spark, sf_dir), LINE_IMAGE)
    return keyless.rows(keyless.net(line_images(spark, sf_dir), changes, LINE_IMAGE), LINE_IMAGE)


@check("cdc_nopk_inconsistent", """SELECT l_orderkey, l_linenumber, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, -count(*) AS n
  FROM lineitem WHERE l_orderkey % 5 = 0 OR l_orderkey % 11 = 0 GROUP BY ALL""")
def cdc_nopk_inconsistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes against an empty table: every before image is missing."""
    changes = keyless.image_changes(keyless_log(spark, sf_dir), LINE_IMAGE)
    netted = keyless.net(line_images(spark, sf_dir).filter("false"), changes, LINE_IMAGE)
    return keyless.inconsistent(netted).withColumn("n", F.col("n").cast("bigint"))


def final_orders(folded: DataFrame) -> DataFrame:
    return folded.filter(F.col("op") != DELETE).select("k.id", "doc.status", "doc.cents")


@check("cdc_dialects", " UNION ALL ".join(f"SELECT '{d}' AS dialect, * FROM ({ORDERS_FINAL_SQL})" for d in ("mysql", "postgres", "relational")))
def cdc_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = orders_log(spark, sf_dir)
    one = lambda d: final_orders(TargetPlan(Settings({"cdc.handler": d})).folded(log)).select(F.lit(d).alias("dialect"), "*")
    return one("mysql").unionByName(one("postgres")).unionByName(one("relational"))


@check("cdc_per_target", f"""WITH {ORDERS_LOG_SQL}, {PATCH_ROWS_SQL}
SELECT 'orders' AS target, count(*) AS n FROM ({ORDERS_FINAL_SQL}) UNION ALL
SELECT 'users', count(DISTINCT user_id) FROM patch_state UNION ALL
SELECT 'plain', count(*) FROM orders""")
def cdc_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handler per target; the target without one takes plain records."""
    settings = Settings({
        "targets": "orders,users,plain", "cdc.handler": "mysql", "cdc.handler.users": "document", "cdc.handler.plain": "",
        "id.strategy.plain": "provided_in_key",
    })
    n = lambda name, df: df.agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"))
    orders = TargetPlan(settings, "orders").folded(orders_log(spark, sf_dir))
    users = TargetPlan(settings, "users")
    users = users.merge(None, users.folded(patch_log(spark, sf_dir)))
    plain = TargetPlan(settings, "plain").folded(order_documents(spark, sf_dir))
    return (
        n("orders", orders.filter(F.col("op") != DELETE))
        .unionByName(n("users", users))
        .unionByName(n("plain", plain))
    )


# -- document sources -------------------------------------------------------


def document(spark: SparkSession, sf_dir: str, target: str = "document") -> DataFrame:
    return errors.good(cdoc.document_ops(patch_log(spark, sf_dir), target))


def users(df: DataFrame) -> DataFrame:
    return df.withColumn("user_id", F.col("k").cast("bigint"))


@check("cdc_doc_tombstone", "SELECT CAST(user_id % 4 AS INT) AS part, count(*) AS n FROM events GROUP BY ALL")
def cdc_doc_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tombstones are dropped; what is left is one operation per event."""
    return document(spark, sf_dir).groupBy(F.col("partition").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@check("cdc_doc_insert", """SELECT event_id * 2 AS off, user_id, event_id AS n, CAST(round(value * 100) AS BIGINT) AS v
  FROM events WHERE event_type = 'signup' AND event_id % 2 = 0""")
def cdc_doc_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = patch_log(spark, sf_dir)
    ops = of_events(users(errors.good(cdoc.document_ops(log))), log, "c", "r")
    number = lambda n: F.col("sets")[n].cast("bigint").alias(n)
    return op_rows(ops, REPLACE).select(F.col("offset").alias("off"), "user_id", number("n"), number("v"))


@check("cdc_doc_replace", """SELECT event_id * 2 AS off, user_id, event_id AS n, CAST(round(value * 100) AS BIGINT) AS v, CAST(3 AS INT) AS fields
  FROM events WHERE event_type = 'signup' AND event_id % 2 = 1""")
def cdc_doc_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches that hold `_id`, as replacements (document target) and delete-insert pairs (row target)."""
    log = patch_log(spark, sf_dir)
    ops = of_events(op_rows(errors.good(cdoc.document_ops(log)), REPLACE), log, "u")
    ops = cdoc.delete_insert_pairs(ops.drop("present"))
    folded = fold.fold_fields(ops.withColumn("k", F.concat_ws("|", "k", "offset")))
    number = lambda n: F.col("sets")[n].cast("bigint").alias(n)
    return folded.filter("reset = 'replace'").select(
        F.col("ord.offset").alias("off"), F.split("k", r"\|")[0].cast("bigint").alias("user_id"), number("n"), number("v"),
        F.size("sets").alias("fields"),
    )


@check("cdc_doc_set", """SELECT event_id * 2 AS off, user_id, 'v' AS f, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v FROM events WHERE event_type IN ('view', 'click')
  UNION ALL SELECT event_id * 2, user_id, 't', '"' || event_type || '"' FROM events WHERE event_type IN ('view', 'click')
  UNION ALL SELECT event_id * 2, user_id, 'p' || (event_id % 5)::VARCHAR, event_id::VARCHAR FROM events WHERE event_type = 'purchase'""")
def cdc_doc_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = op_rows(users(document(spark, sf_dir)), SET)
    return ops.select(F.col("offset").alias("off"), "user_id", F.explode("sets").alias("f", "v"))


@check("cdc_doc_unset", """SELECT t.target, event_id * 2 AS off, user_id, 'v' AS f, CASE WHEN t.target = 'row' THEN 'null' END AS v
  FROM events, (VALUES ('document'), ('row')) t(target) WHERE event_type = 'error' AND event_id % 4 <> 0""")
def cdc_doc_unset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document targets lose the field, row targets get a null."""
    log = patch_log(spark, sf_dir)
    head = lambda t: [F.lit(t).alias("target"), F.col("offset").alias("off"), "user_id"]
    gone = users(errors.good(cdoc.document_ops(log))).select(
        *head("document"), F.explode("unsets").alias("f"), F.lit(None).cast("string").alias("v")
    )
    nulled = users(errors.good(cdoc.document_ops(log, "row"))).select(*head("row"), F.explode("sets").alias("f", "v")).filter("v = 'null'")
    return gone.unionByName(nulled)


@check("cdc_doc_strip_v", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS marked FROM events WHERE event_type IN ('view', 'click', 'signup')")
def cdc_doc_strip_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches carry a version mark; operations do not."""
    marked = F.map_contains_key("sets", "$v") | F.array_contains("unsets", "$v")
    log = patch_log(spark, sf_dir).filter("value.patch LIKE '%$v%' OR value.op = 'c'")
    return errors.good(cdoc.document_ops(log)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(marked.cast("bigint")).alias("marked")
    )


@check("cdc_doc_delete", "SELECT event_id * 2 AS off, user_id FROM events WHERE event_type = 'error' AND event_id % 4 = 0")
def cdc_doc_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op_rows(users(document(spark, sf_dir)), DELETE).select(F.col("offset").alias("off"), "user_id")


@check("cdc_doc_bad_records", """SELECT CASE WHEN event_id % 7 = 0 THEN 'key is missing' WHEN event_id % 5 = 0 THEN 'patch is no JSON object'
    WHEN event_id % 3 = 0 THEN 'key id is no JSON text' ELSE 'good' END AS reason, count(*) AS n
  FROM events WHERE event_type IN ('view', 'click') GROUP BY 1""")
def cdc_doc_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.call_function("div", F.col("offset"), F.lit(2))
    log = patch_log(spark, sf_dir).filter("value.patch LIKE '%$set\":{\"v\"%'")
    v = F.col("value")
    patch = F.when(n % 5 == 0, F.lit("{oops")).otherwise(v["patch"])
    key_id = F.when(n % 3 == 0, F.concat(F.lit("not json "), F.col("key.id"))).otherwise(F.col("key.id"))
    faulty = log.withColumn("value", F.struct(v["op"].alias("op"), v["after"].alias("after"), patch.alias("patch"))).withColumn(
        "key", F.when(n % 7 != 0, F.struct(key_id.alias("id")))
    )
    ops = cdoc.document_ops(faulty)
    return ops.groupBy(F.coalesce("err", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# -- row targets ------------------------------------------------------------

ROW = "id, status, cents"


@check("cdc_row_insert", f"WITH {ORDERS_LOG_SQL} SELECT off, k AS id, after_status AS status, after_cents AS cents FROM log9 WHERE op IN ('c', 'r')")
def cdc_row_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = relational(spark, sf_dir, "row").filter("op = 'set' AND upsert")
    return flat(ops.withColumnRenamed("offset", "off"), "off", "doc")


@check("cdc_row_update", f"WITH {ORDERS_LOG_SQL} SELECT off, k AS id, after_status AS status, after_cents AS cents FROM log9 WHERE op = 'u'")
def cdc_row_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = relational(spark, sf_dir, "row").filter("op = 'set' AND NOT upsert")
    return flat(ops.withColumnRenamed("offset", "off"), "off", "doc")


def empty_rows(ops: DataFrame) -> DataFrame:
    """An empty target for the given operations."""
    return ops.select("k", "doc").limit(0)


@check("cdc_row_delete", ORDERS_FINAL_SQL)
def cdc_row_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates and deletes folded into an empty row table."""
    ops = relational(spark, sf_dir, "row")
    rows = merge.merge_columns(empty_rows(ops), fold.fold_columns(ops, mixed_upserts=True, width=1000))
    return flat(rows, "doc")


# Live fields of each user as columns of a row table.
USER_COLUMNS = ["n", "v", "t", "p0", "p1", "p2", "p3", "p4"]
USER_ROWS_SQL = f"""WITH {PATCH_ROWS_SQL}
SELECT user_id, {", ".join(
    f"max(CASE WHEN f = '{c}' AND act = 'set' THEN {'v' if c == 't' else 'CAST(v AS BIGINT)'} END) AS {c}" if c != 't'
    else "max(CASE WHEN f = 't' AND act = 'set' THEN replace(v, '\"', '') END) AS t" for c in USER_COLUMNS)}
FROM patch_state GROUP BY user_id"""


def typed_partial(ops: DataFrame, columns: list[str]) -> DataFrame:
    """JSON operations as partial rows of a typed table."""
    value = lambda c: (jsontext.unwrap_extended_id(F.col("sets")[c]) if c == "t" else F.col("sets")[c].try_cast("bigint")).alias(c)
    return ops.select(
        "k", "op", "upsert", "ord", F.struct(*[value(c) for c in columns]).alias("doc"),
        F.when(F.col("op") == SET, F.map_keys("sets")).alias("present"),
    )


@check("cdc_row_doc_insert", """SELECT user_id, event_id * 2 AS off, event_id AS n, CAST(round(value * 100) AS BIGINT) AS v FROM events
  WHERE event_type = 'signup'""")
def cdc_row_doc_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as rows, under the columns found in the batch."""
    ops = op_rows(users(document(spark, sf_dir, "row")), REPLACE)
    docs = ops.select("user_id", F.col("offset").alias("off"), jsontext.document(F.col("sets")).alias("doc"))
    typed = evolve.typed(docs, evolve.infer(docs))
    return flat(typed, "user_id", "off", "doc").drop("_id")


@check("cdc_row_doc_patch", USER_ROWS_SQL)
def cdc_row_doc_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches as partial rows: listed columns change, the others keep their value."""
    ops = typed_partial(document(spark, sf_dir, "row"), USER_COLUMNS)
    rows = merge.merge_columns(empty_rows(ops), fold.fold_columns(ops))
    return rows.select(F.col("k").cast("bigint").alias("user_id"), "doc.*")


@check("evo_add_columns", """SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN CAST(user_id + CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END AS DECIMAL(20,1)) END AS amount,
  CASE WHEN event_type = 'view' THEN event_type END AS seen, CASE WHEN event_type = 'click' THEN 'c' ELSE CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END END AS code,
  CASE WHEN event_type = 'purchase' THEN user_id END AS buyer_id FROM events""")
def evo_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table takes two batches of JSON documents with new fields and wider types."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    js = lambda *cols: F.to_json(F.struct(F.col("event_id").alias("id"), *cols)).alias("doc")
    amount, code = F.col("user_id").alias("amount"), F.col("event_id").alias("code")
    first = e.filter(~kind.isin("click", "error")).select(
        js(amount, code, F.when(kind == "view", kind).alias("seen"),
           F.when(kind == "purchase", F.struct(F.col("user_id").alias("id"))).alias("buyer"))
    )
    second = e.filter(kind.isin("click", "error")).select(
        js(F.when(kind == "click", F.col("user_id") + 0.5).alias("amount"), F.when(kind == "click", F.lit("c")).alias("code"))
    )
    rows = lambda d: evolve.typed(d, evolve.infer(d)).select("doc.*")
    return flat(evolve.union_grown(rows(first), rows(second)).select(F.struct("*").alias("doc")), "doc")


# -- write models -----------------------------------------------------------

ACCOUNTS_SQL = """
acc AS (SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, event_id % 9 = 0 AS gone FROM events)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain records per user: some without value, each with two fields of the event."""
    e = table(spark, sf_dir, "events")
    value = F.struct(F.col("user_id").alias("_id"), F.col("event_type").alias("last"), cents("value").alias("cents"))
    return e.select(
        F.lit("shop.accounts").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.struct(F.col("user_id").alias("_id")).alias("key"), F.when(F.col("event_id") % 9 != 0, value).alias("value"),
    )


def middle(spark: SparkSession, sf_dir: str) -> int:
    """The event id that parts the older half of the events from the newer."""
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2


@check("wm_replace", f"WITH {ACCOUNTS_SQL} SELECT user_id AS _id, arg_max(event_type, event_id) AS last, arg_max(cents, event_id) AS cents FROM acc WHERE NOT gone GROUP BY user_id")
def wm_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = errors.good(wm.write_ops(accounts(spark, sf_dir), wm.replace_by_id))
    return flat(fold.fold_latest(ops), "doc")


@check("wm_business_key", f"""WITH {ACCOUNTS_SQL}, h AS (SELECT event_type AS last, user_id % 50 AS grp, event_id < (SELECT max(event_id) // 2 FROM events) AS old, event_id, cents FROM acc WHERE NOT gone)
SELECT last, grp, arg_max(cents, event_id) AS cents, CAST(bool_or(old) AS INT) AS kept_id FROM h GROUP BY last, grp""")
def wm_business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target from the older half takes the newer half: documents known before keep their `_id`."""
    log = accounts(spark, sf_dir).filter("value IS NOT NULL")
    key = F.struct("value.last", (F.col("key._id") % 50).alias("grp"))
    log = log.withColumn("value", F.struct(key.alias("_id"), "value.cents"))
    half = middle(spark, sf_dir)
    side = lambda cond: fold.fold_latest(errors.good(wm.write_ops(log.filter(cond), wm.replace_by_business_key)))
    older, newer = side(F.col("offset") < half), side(F.col("offset") >= half)
    empty = older.select("k", "doc", F.lit(None).cast("string").alias(ID)).limit(0)
    target = merge.merge_latest(empty, older, generated_id=F.lit("old"))
    rows = merge.merge_latest(target, newer, generated_id=F.lit("new"))
    return rows.select("k.last", "k.grp", "doc.cents", (F.col(ID) == "old").cast("int").alias("kept_id"))


@check("wm_timestamps", f"""WITH {ACCOUNTS_SQL}, h AS (SELECT *, event_id < (SELECT max(event_id) // 2 FROM events) AS old FROM acc WHERE NOT gone AND user_id % 7 <> (CASE WHEN event_id < (SELECT max(event_id) // 2 FROM events) THEN 0 ELSE 1 END))
SELECT user_id AS _id, arg_max(event_type, event_id) AS last, arg_max(cents, event_id) AS cents,
  CAST(CASE WHEN bool_or(NOT old) THEN 2000 ELSE 1000 END AS BIGINT) AS "_modifiedTS", CAST(CASE WHEN bool_or(old) THEN 1000 ELSE 2000 END AS BIGINT) AS "_insertedTS"
FROM h GROUP BY user_id""")
def wm_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs at times 1000 and 2000: some users are in the first only, some in the second only."""
    log = accounts(spark, sf_dir).filter("value IS NOT NULL")
    half = middle(spark, sf_dir)
    at = lambda ms: F.timestamp_millis(F.lit(ms))
    side = lambda cond, ms: fold.fold_columns(errors.good(wm.write_ops(log.filter(cond), wm.set_with_timestamps(at(ms)))))
    older = side((F.col("offset") < half) & (F.col("key._id") % 7 != 0), 1000)
    newer = side((F.col("offset") >= half) & (F.col("key._id") % 7 != 1), 2000)
    empty = older.select("k", F.struct(F.lit(None).cast("bigint").alias("_id")).alias("doc")).limit(0)
    first = merge.merge_columns(empty, older, on_insert={wm.INSERTED: at(1000)})
    return flat(merge.merge_columns(first, newer, on_insert={wm.INSERTED: at(2000)}), "doc")


@check("wm_delete_on_null", f"""WITH {ACCOUNTS_SQL} SELECT user_id AS _id, arg_max(event_type, event_id) AS last, arg_max(cents, event_id) AS cents FROM acc
  GROUP BY user_id HAVING NOT arg_max(gone, event_id)""")
def wm_delete_on_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    deletes = wm.delete_by_id(ids.provided_in_key)
    ops = errors.good(wm.write_ops(accounts(spark, sf_dir), wm.replace_by_id, deletes))
    return flat(fold.fold_latest(ops).filter(F.col("op") != DELETE), "doc")


@check("wm_delete_legacy", """SELECT CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE '{"_id":null,"user":' || user_id::VARCHAR || '}' END AS k, count(*) AS n
  FROM events WHERE event_id % 9 = 0 GROUP BY ALL""")
def wm_delete_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an id strategy the key's `_id` finds the document, else the whole key does."""
    log = accounts(spark, sf_dir)
    key = F.struct(F.when(F.col("offset") % 2 == 0, F.col("key._id")).alias("_id"), F.col("key._id").alias("user"))
    value = F.when(F.col("value").isNotNull(), F.struct(F.col("key._id").cast("string").alias("_id")))
    log = log.withColumn("value", value).withColumn("key", key)
    ops = op_rows(errors.good(wm.write_ops(log, wm.replace_by_id, wm.delete_by_key)), DELETE)
    return ops.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def halves_sql(extra: str = "") -> str:
    return f"""WITH {ACCOUNTS_SQL} SELECT user_id AS id, arg_max(event_type, event_id) FILTER (NOT gone) AS last,
  arg_max(cents, event_id) AS cents{extra} FROM acc GROUP BY user_id"""


def partial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which some records leave out a column."""
    log = accounts(spark, sf_dir)
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), "event_type", cents("value").alias("c"))
    value = F.struct(F.col("key._id").alias("id"), F.col("event_type").alias("last"), F.col("c").alias("cents"))
    return log.drop("value").join(e, "offset").withColumn("value", value).drop("event_type", "c")


def as_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON texts, decoded; every ninth does not hold the column `last`."""
    log = partial_rows(spark, sf_dir)
    last = F.when(F.col("offset") % 9 != 0, F.col("value.last"))
    log = log.withColumn("value", F.to_json(F.struct(F.col("value.id").alias("id"), last.alias("last"), F.col("value.cents").alias("cents"))))
    return dec.decode(log, None, dec.JsonPlain(T.StructType.fromDDL("id bigint, last string, cents bigint")))


@check("wm_row_upsert", halves_sql())
def wm_row_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = errors.good(wm.write_ops(as_read(spark, sf_dir), wm.row_upsert(["id"])))
    return flat(merge.merge_columns(empty_rows(ops), fold.fold_columns(ops)), "doc")


@check("wm_row_upsert_ts", halves_sql(', CAST(1700000000000 AS BIGINT) AS "modified_ms"'))
def wm_row_upsert_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = wm.row_upsert(["id"], F.lit(1_700_000_000_000))
    ops = errors.good(wm.write_ops(as_read(spark, sf_dir), model))
    return flat(merge.merge_columns(empty_rows(ops), fold.fold_columns(ops)), "doc")


@check("wm_row_delete", f"""WITH {ACCOUNTS_SQL}, d AS (SELECT user_id, max(event_id) FILTER (gone) AS gone_id FROM acc GROUP BY user_id)
SELECT user_id AS id, arg_max(event_type, event_id) AS last, arg_max(cents, event_id) AS cents FROM acc JOIN d USING (user_id)
WHERE event_id > coalesce(gone_id, -1) GROUP BY user_id""")
def wm_row_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = partial_rows(spark, sf_dir)
    log = rows.withColumn("value", F.when(F.col("offset") % 9 != 0, F.col("value"))).withColumn(
        "key", F.struct(F.col("key._id").alias("id"))
    )
    ops = errors.good(wm.write_ops(log, wm.row_upsert(["id"]), wm.row_delete(["id"])))
    return flat(merge.merge_columns(empty_rows(ops), fold.fold_columns(ops)), "doc")


# -- own parts --------------------------------------------------------------


@check("ext_custom_hooks", f"""WITH {ORDERS_LOG_SQL}
SELECT 'hooks' AS what, 'doc-' || o_orderkey::VARCHAR AS k, upper(o_orderstatus) || '!' AS status FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'hooks', 'doc-' || o_orderkey::VARCHAR, NULL FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT CASE WHEN op = 'd' THEN 'op is not handled: d' ELSE 'handled' END, CAST(k AS VARCHAR), after_status FROM log9 WHERE op IN ('c', 'd')""")
def ext_custom_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An own id strategy, step, write model and a partial map of change-event operations."""
    docs = order_documents(spark, sf_dir).withColumn("value", F.struct("value.status"))

    def redact(df: DataFrame) -> DataFrame:
        v = F.col("value")
        keep = F.when(F.col("offset") % 2 == 0, F.concat(F.upper(v["status"]), F.lit("!")))
        return df.withColumn("value", F.struct(v[ID].alias(ID), keep.alias("status")))

    registry = Registry(
        steps={"redact": redact},
        id_strategies={"named": lambda df: (F.concat(F.lit("doc-"), F.col("key._id").cast("string")), [])},
        write_models={"by_name": lambda df: wm.Op(F.col("value._id"), REPLACE, True, F.col("value"))},
        operations={"inserts_only": {"c": crel.Built(REPLACE)}},
    )
    settings = Settings({"id.strategy": "named", "processors": "redact", "write.model": "by_name", "on.error": "reject"})
    folded = TargetPlan(settings, registry=registry).folded(docs)
    hooks = folded.select(F.lit("hooks").alias("what"), "k", "doc.status")

    log = orders_log(spark, sf_dir).filter("value.op IN ('c', 'd')")
    ops = crel.relational_ops(log, operations=registry.operations["inserts_only"])
    return hooks.unionByName(
        ops.select(F.coalesce("err", F.lit("handled")).alias("what"), F.col("k.id").cast("string").alias("k"), "doc.status")
    )
