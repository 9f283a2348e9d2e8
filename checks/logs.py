"""Change logs and documents derived from the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.support import cents, table

ORDER_IMAGE = "struct<id:bigint,status:string,cents:bigint>"


def order_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps in the life of each order: inserted, changed, deleted, buried, inserted again."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    seq = lambda n: F.lit(n)
    steps = F.filter(
        F.array(
            seq(0),
            F.when(k % 3 == 0, seq(1)),
            F.when(k % 7 == 0, seq(2)),
            F.when(k % 7 == 0, seq(3)),
            F.when(k % 21 == 0, seq(4)),
        ),
        lambda x: x.isNotNull(),
    )
    return o.select(
        k.alias("k"), F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents"),
        F.col("o_orderdate").cast("timestamp").alias("day"), F.col("o_custkey").alias("cust"),
        F.explode(steps).alias("seq"),
    )


def with_log_position(df: DataFrame, topic: str = "shop.orders") -> list[Column]:
    seq = F.col("seq")
    return [
        F.lit(topic).alias("topic"),
        (F.col("k") % 4).cast("int").alias("partition"),
        (F.col("k") * 8 + seq).alias("offset"),
        F.timestamp_millis(F.unix_millis("day") + seq * 1000).alias("timestamp"),
        F.lit("CREATE_TIME").alias("timestamp_type"),
    ]


def orders_log(spark: SparkSession, sf_dir: str, topic: str = "shop.orders") -> DataFrame:
    """Relational change log of orders: typed key and envelope."""
    return envelopes(order_steps(spark, sf_dir), topic)


def envelopes(steps: DataFrame, topic: str = "shop.orders") -> DataFrame:
    k, seq = F.col("k"), F.col("seq")
    image = lambda status, c: F.struct(k.alias("id"), status.alias("status"), c.alias("cents"))
    first = image(F.col("status"), F.col("cents"))
    changed = image(F.lit("X"), F.col("cents") + 10000)
    again = image(F.lit("N"), F.lit(100).cast("bigint"))
    op = F.when((seq == 0) & (k % 5 == 0), "r").when(seq.isin(0, 4), "c").when(seq == 1, "u").when(seq == 2, "d")
    before = F.when(seq == 1, first).when(seq == 2, F.when(k % 3 == 0, changed).otherwise(first))
    after = F.when(seq == 0, first).when(seq == 1, changed).when(seq == 4, again)
    value = F.struct(op.alias("op"), before.alias("before"), after.alias("after"))
    return steps.select(
        *with_log_position(steps, topic),
        F.struct(k.alias("id")).alias("key"),
        F.when(seq != 3, value).alias("value"),
    )


def as_text(log: DataFrame) -> DataFrame:
    """Key and value as JSON text, as they lie in a log."""
    text = lambda c: F.to_json(F.col(c), {"ignoreNullFields": "false"}).alias(c)
    return log.select(*[text(c) if c in ("key", "value") else F.col(c) for c in log.columns])


ORDERS_LOG_SQL = """
log9 AS (
  SELECT 'shop.orders' AS topic, CAST(o_orderkey % 4 AS INT) AS part, o_orderkey * 8 + seq AS off,
    o_orderkey AS k, seq, epoch_ms(o_orderdate) + seq * 1000 AS ms, o_custkey AS cust,
    CASE WHEN seq = 0 AND o_orderkey % 5 = 0 THEN 'r' WHEN seq IN (0, 4) THEN 'c' WHEN seq = 1 THEN 'u'
         WHEN seq = 2 THEN 'd' END AS op,
    CASE WHEN seq = 0 THEN o_orderstatus WHEN seq = 1 THEN 'X' WHEN seq = 4 THEN 'N' END AS after_status,
    CASE WHEN seq = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT)
         WHEN seq = 1 THEN CAST(round(o_totalprice * 100) AS BIGINT) + 10000
         WHEN seq = 4 THEN CAST(100 AS BIGINT) END AS after_cents
  FROM orders CROSS JOIN (SELECT * FROM (VALUES (0), (1), (2), (3), (4)) t(seq)) s
  WHERE seq = 0 OR (seq = 1 AND o_orderkey % 3 = 0) OR (seq IN (2, 3) AND o_orderkey % 7 = 0)
     OR (seq = 4 AND o_orderkey % 21 = 0)
)"""

# The final state in closed form, without any fold.
ORDERS_FINAL_SQL = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 21 = 0 THEN 'N' WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 21 = 0 THEN CAST(100 AS BIGINT)
       WHEN o_orderkey % 3 = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) + 10000
       ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents
FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 21 = 0"""


def patch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document change log of events per user: JSON texts in key, after and patch."""
    e = table(spark, sf_dir, "events")
    kind, n = F.col("event_type"), F.col("event_id")
    v = cents("value")
    js = lambda *cols: F.to_json(F.struct(*cols))
    full = lambda *head: js(*head, F.col("user_id").alias("_id"), n.alias("n"), v.alias("v"))
    mark = F.lit(1).alias("$v")
    set_of = lambda *cols: js(mark, F.struct(*cols).alias("$set"))
    purchase = F.concat(
        F.lit('{"$set":{"p'), (n % 5).cast("string"), F.lit('":'), n.cast("string"), F.lit("}}")
    )
    op = (
        F.when((kind == "signup") & (n % 2 == 0), "c")
        .when((kind == "error") & (n % 4 == 0), "d")
        .otherwise("u")
    )
    patch = (
        F.when(kind == "signup", full(mark))
        .when(kind.isin("view", "click"), set_of(v.alias("v"), kind.alias("t")))
        .when(kind == "purchase", purchase)
        .otherwise(js(F.struct(F.lit(True).alias("v")).alias("$unset")))
    )
    # every delete is followed by a tombstone
    parts = F.explode(F.when(op == "d", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("sub")
    base = e.select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), op.alias("op"),
        F.when(op == "c", full()).alias("after"), F.when(op == "u", patch).alias("patch"), parts,
    )
    value = F.struct("op", "after", "patch")
    return base.select(
        F.lit("shop.users").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("sub")).alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit("CREATE_TIME").alias("timestamp_type"),
        F.struct(F.col("user_id").cast("string").alias("id")).alias("key"),
        F.when(F.col("sub") == 0, value).alias("value"),
    )


PATCH_ROWS_SQL = """
ev AS (SELECT user_id, event_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
         event_type = 'error' AND event_id % 4 = 0 AS del FROM events),
resets AS (SELECT user_id, max(event_id) AS r,
         arg_max(CASE WHEN del THEN 'd' ELSE 'c' END, event_id) AS kind
       FROM ev WHERE event_type = 'signup' OR del GROUP BY user_id),
fields AS (
  SELECT user_id, event_id, '_id' AS f, 'set' AS act, CAST(user_id AS VARCHAR) AS v FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT user_id, event_id, 'n', 'set', CAST(event_id AS VARCHAR) FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT user_id, event_id, 'v', 'set', CAST(cents AS VARCHAR) FROM ev WHERE event_type IN ('signup', 'view', 'click')
  UNION ALL SELECT user_id, event_id, 't', 'set', '"' || event_type || '"' FROM ev WHERE event_type IN ('view', 'click')
  UNION ALL SELECT user_id, event_id, 'p' || CAST(event_id % 5 AS VARCHAR), 'set', CAST(event_id AS VARCHAR) FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT user_id, event_id, 'v', 'unset', NULL FROM ev WHERE event_type = 'error' AND NOT del
),
live AS (
  SELECT user_id, f, arg_max(struct_pack(act := act, v := v), event_id) AS e, max(event_id) AS last_id
  FROM fields JOIN resets USING (user_id)
  WHERE kind = 'c' AND event_id >= r GROUP BY user_id, f
),
patch_state AS (SELECT user_id, f, e.act AS act, e.v AS v, last_id FROM live)"""


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested key and value documents, one per order."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    k = F.col("o_orderkey")
    line = lambda i: F.struct(
        (k % 2000 + i).alias("part"), i.cast("int").alias("qty"), (cents("o_totalprice") * i).alias("cents")
    )
    lines = F.transform(F.sequence(F.lit(1).cast("bigint"), k % 3 + 1), line)
    lut = F.map_from_arrays(F.array(F.lit("F"), F.lit("N"), F.lit("R")), F.array(k % 10, k % 100, k % 1000))
    nation = F.struct(F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    customer = F.struct(
        F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        nation.alias("nation"),
    )
    value = F.struct(
        k.alias("_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").startswith("1").alias("urgent"), cents("o_totalprice").alias("cents"),
        customer.alias("customer"), lines.alias("lines"), lut.alias("lut"),
    )
    key = F.struct(
        k.alias("_id"), F.col("r_name").alias("region"),
        F.struct(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("segment")).alias("buyer"),
        F.struct(F.col("n_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("origin"),
    )
    return j.select(
        F.lit("shop.documents").alias("topic"), (k % 4).cast("int").alias("partition"), k.alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.when(k % 2 == 0, "CREATE_TIME").otherwise("LOG_APPEND_TIME").alias("timestamp_type"),
        key.alias("key"), value.alias("value"),
    )


DOCS_SQL = """
docs AS (
  SELECT o_orderkey AS _id, o_orderstatus AS status, CAST(o_orderpriority LIKE '1%' AS INT) AS urgent,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    c_custkey AS customer__id, c_name AS customer_name, c_mktsegment AS customer_segment,
    n_name AS customer_nation_name, r_name AS customer_nation_region,
    array_to_string([(o_orderkey % 2000 + i)::VARCHAR || ':' || i::VARCHAR || ':' ||
      (CAST(round(o_totalprice * 100) AS BIGINT) * i)::VARCHAR for i in range(1, o_orderkey % 3 + 2)], ',') AS lines,
    array_to_string([(o_orderkey % 2000 + i)::VARCHAR for i in range(1, o_orderkey % 3 + 2)], ',') AS lines_part,
    array_to_string([i::VARCHAR || ':' || (CAST(round(o_totalprice * 100) AS BIGINT) * i)::VARCHAR
      for i in range(1, o_orderkey % 3 + 2)], ',') AS lines_qty_cents,
    'F=' || (o_orderkey % 10)::VARCHAR AS lut_f, 'N=' || (o_orderkey % 100)::VARCHAR AS lut_n,
    'R=' || (o_orderkey % 1000)::VARCHAR AS lut_r,
    o_orderkey % 4 AS part, epoch_ms(o_orderdate) AS ms
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


def turns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log with a compound key: the turns of conversations, some changed, some deleted."""
    c = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    steps = F.filter(
        F.array(F.lit(0), F.when(turn % 3 == 1, F.lit(1)), F.when((conv + turn) % 5 == 0, F.lit(2))),
        lambda x: x.isNotNull(),
    )
    s = c.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"), F.explode(steps).alias("seq"))
    seq = F.col("seq")
    row = F.struct(
        "conv_id", "turn",
        F.when(seq == 1, F.upper("role")).otherwise(F.col("role")).alias("role"),
        (F.col("chars") + seq).alias("chars"),
    )
    op = F.when(seq == 0, "c").when(seq == 1, "u").otherwise("d")
    image = row
    return s.select(
        F.lit("chat.turns").alias("topic"),
        (conv % 4).cast("int").alias("partition"),
        ((conv * 1000 + turn) * 4 + seq).alias("offset"),
        F.timestamp_millis((conv * 1000 + turn) * 1000).alias("timestamp"),
        F.lit("CREATE_TIME").alias("timestamp_type"),
        F.struct("conv_id", "turn").alias("key"),
        F.struct(
            op.alias("op"),
            F.when(seq > 0, image).alias("before"),
            F.when(seq < 2, image).alias("after"),
        ).alias("value"),
    )


TURNS_FINAL_SQL = """
turns AS (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN upper(role) ELSE role END AS role,
    CAST(length(text) + CASE WHEN turn % 3 = 1 THEN 1 ELSE 0 END AS BIGINT) AS chars
  FROM conversations WHERE (conv_id + turn) % 5 <> 0
)"""

LINE_IMAGE = ["l_orderkey", "l_linenumber", "l_returnflag", "cents"]


def line_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", cents("l_extendedprice").alias("cents"))


def keyless_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of a table without key: some rows changed, some deleted, by their before image."""
    li = line_images(spark, sf_dir)
    k = F.col("l_orderkey")
    op = F.when(k % 5 == 0, "u").when(k % 11 == 0, "d")
    image = F.struct(*LINE_IMAGE)
    changed = F.struct("l_orderkey", "l_linenumber", F.lit("X").alias("l_returnflag"), (F.col("cents") + 1).alias("cents"))
    value = F.struct(op.alias("op"), image.alias("before"), F.when(op == "u", changed).alias("after"))
    return li.filter(op.isNotNull()).select(
        F.lit("shop.lines").alias("topic"), (k % 4).cast("int").alias("partition"),
        (k * 8 + F.col("l_linenumber")).alias("offset"), value.alias("value"),
    )
