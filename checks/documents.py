"""Projection, renaming, metadata and processor chains on nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.logs import DOCS_SQL, order_documents
from checks.support import check, flat, table
from tidefold.operators import meta, project as prj, rename as ren
from tidefold.plans.settings import Settings
from tidefold.plans.target_plan import TargetPlan

NATION = "customer_nation_name, customer_nation_region"
CUSTOMER = f"customer__id, customer_name, customer_segment, {NATION}"
LUT = "lut_f || ',' || lut_n || ',' || lut_r AS lut"
KEY_ALL = "_id, customer_nation_region AS region, customer__id AS buyer_cust, customer_segment AS buyer_segment, customer_nation_name AS origin_name, customer_segment AS origin_segment"


def select_docs(columns: str) -> str:
    return f"WITH {DOCS_SQL} SELECT {columns} FROM docs"


def projected(side: str, kind: str, rules: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(prj.project(order_documents(spark, sf_dir), side, prj.projection(kind, rules)), side)

    return query


PROJECTIONS = {
    "prj_black_value": ("value", "blacklist", "cents,customer.segment,missing.x", f"_id, status, urgent, customer__id, customer_name, {NATION}, lines, {LUT}"),
    "prj_black_key": ("key", "blacklist", "region,buyer.cust", "_id, customer_segment AS buyer_segment, customer_nation_name AS origin_name, customer_segment AS origin_segment"),
    "prj_white_value": ("value", "whitelist", "status,customer.nation.name", "_id, status, customer_nation_name"),
    "prj_white_key": ("key", "whitelist", "region,origin.name", "_id, customer_nation_region AS region, customer_nation_name AS origin_name"),
    "prj_black_nested_array": ("value", "blacklist", "lines.part,customer.nation.region", f"_id, status, urgent, cents, customer__id, customer_name, customer_segment, customer_nation_name, lines_qty_cents AS lines, {LUT}"),
    "prj_black_star": ("value", "blacklist", "*.*", f"_id, customer__id, {NATION}, '' AS lut"),
    "prj_black_dstar": ("value", "blacklist", "customer.**,lines", f"_id, status, urgent, cents, customer__id, {LUT}"),
    "prj_white_nested_array": ("value", "whitelist", "lines.part,customer.segment", "_id, customer_segment, lines_part AS lines"),
    "prj_white_star": ("value", "whitelist", "*.segment,customer.*.name", "_id, status, urgent, cents, customer__id, customer_name, customer_segment, customer_nation_name, '' AS lut"),
    "prj_white_dstar": ("value", "whitelist", "customer.**,lut.**", f"_id, {CUSTOMER}, {LUT}"),
    "prj_id_protected": ("value", "blacklist", "_id,customer._id,customer.name,status", f"_id, urgent, cents, customer__id, customer_segment, {NATION}, lines, {LUT}"),
    "prj_map_key": ("value", "blacklist", "lut.N,lut.missing,lines,customer.nation", "_id, status, urgent, cents, customer__id, customer_name, customer_segment, lut_f || ',' || lut_r AS lut"),
}
for _name, (_side, _kind, _rules, _columns) in PROJECTIONS.items():
    check(_name, select_docs(_columns))(projected(_side, _kind, _rules))


@check("prj_white_map_key", select_docs("_id, lut_n AS lut"))
def prj_white_map_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected("value", "whitelist", "lut.N")(spark, sf_dir)


@check("ren_mapping", select_docs(
    "_id, customer_nation_region AS area, customer__id AS buyer_cust, customer_segment AS buyer_market, "
    "customer_nation_name AS origin_name, customer_segment AS origin_segment, status AS state, cents AS amount"))
def ren_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ren.ByMapping({"key.region": "area", "key.buyer.segment": "market", "value.status": "state", "value.cents": "amount", "value.area": "nowhere"})
    df = ren.rename(order_documents(spark, sf_dir), names)
    some = df.select("key", F.struct("value.state", "value.amount").alias("value"))
    return flat(some, "key", "value")


@check("ren_regexp", select_docs(
    "_id, status AS st_us, urgent, cents, customer__id AS cust__id, customer_name AS cust_label, "
    "customer_segment AS cust_segment, customer_nation_name AS cust_nation_label, customer_nation_region AS cust_nation_region, "
    "lines, 'L_' || lut_f || ',L_' || lut_n || ',L_' || lut_r AS lut"))
def ren_regexp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ren.ByRegExp([
        ren.NameRule(r"^value\.st.*$", "at", "_"),
        ren.NameRule(r"value\.customer", "(cust)omer", "$1"),
        ren.NameRule(r".*\.name", "^name$", "label"),
        ren.NameRule(r"value\.lut\..*", "^", "L_"),
        ren.NameRule(r"lut", "lut", "partial matches change nothing"),
    ])
    return flat(ren.rename(order_documents(spark, sf_dir), rules, ["value"]), "value")


@check("ren_nested", select_docs(
    "_id, customer__id AS buyer__id, customer_name AS buyer_name, customer_segment AS buyer_segment, "
    "customer_nation_name AS buyer_country_title, customer_nation_region AS buyer_country_region, lines"))
def ren_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children are found under the new name of their parent; arrays are not entered."""
    names = ren.ByMapping({
        "value.customer": "buyer",
        "value.buyer.nation": "country",
        "value.buyer.country.name": "title",
        "value.customer.segment": "unreached",
        "value.lines.part": "unreached",
    })
    df = ren.rename(order_documents(spark, sf_dir), names, ["value"])
    return flat(df.select(F.struct("value._id", "value.buyer", "value.lines").alias("value")), "value")


@check("ren_collision", select_docs("_id, status, urgent, cents AS amount"))
def ren_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field whose new name is taken keeps its old one."""
    names = ren.ByMapping({"value.status": "urgent", "value.cents": "amount", "value.urgent": "amount"})
    docs = order_documents(spark, sf_dir).withColumn(
        "value", F.struct("value._id", "value.status", "value.cents", "value.urgent")
    )
    return flat(ren.rename(docs, names, ["value"]), "value")


@check("meta_adder", select_docs(
    "_id, status, 'shop.documents-' || part::VARCHAR || '-' || _id::VARCHAR AS \"topic-partition-offset\", "
    "CASE WHEN _id % 2 = 0 THEN ms END AS \"CREATE_TIME\", CASE WHEN _id % 2 = 1 THEN ms END AS \"LOG_APPEND_TIME\""))
def meta_adder(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = order_documents(spark, sf_dir).withColumn("value", F.struct("value._id", "value.status"))
    return flat(meta.add_log_metadata(docs), "value")


@check("case_fold_names", "SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS custkey FROM orders")
def case_fold_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.struct(F.col("o_orderkey").alias("ID"), F.col("o_orderstatus").alias("Status"), F.col("o_custkey").alias("custKey")).alias("value"))
    return flat(ren.lower_case(rows, "value"), "value")


CHAIN = {
    "id.strategy": "provided_in_key",
    "processors": "value.projection,rename.mapping,log.metadata",
    "value.projection.type": "blacklist",
    "value.projection.list": "cents,lines,lut,customer.nation,customer._id",
    "rename.mapping": '[{"oldName": "value.customer", "newName": "buyer"}, {"oldName": "value.buyer.segment", "newName": "market"}]',
}


@check("chain_composed", select_docs(
    "_id, status, urgent, customer__id AS buyer__id, customer_name AS buyer_name, customer_segment AS buyer_market, "
    "'shop.documents-' || part::VARCHAR || '-' || _id::VARCHAR AS \"topic-partition-offset\", "
    "CASE WHEN _id % 2 = 0 THEN ms END AS \"CREATE_TIME\", CASE WHEN _id % 2 = 1 THEN ms END AS \"LOG_APPEND_TIME\""))
def chain_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = TargetPlan(Settings(CHAIN))
    return flat(plan.process(order_documents(spark, sf_dir)), "value")


@check("chain_per_target", f"""
WITH {DOCS_SQL}
SELECT 'urgent' AS target, count(*) AS n, CAST(sum(length(status)) AS BIGINT) AS has_status,
  CAST(0 AS BIGINT) AS has_name, CAST(sum(cents) AS BIGINT) AS amount FROM docs WHERE urgent = 1
UNION ALL
SELECT 'other', count(*), CAST(0 AS BIGINT), count(customer_name), CAST(0 AS BIGINT) FROM docs WHERE urgent = 0
""")
def chain_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain and write model of each target, with the global setting as fallback."""
    settings = Settings({
        "targets": "urgent,other",
        "id.strategy": "provided_in_value",
        "processors": "value.projection",
        "value.projection.type": "whitelist",
        "value.projection.list": "customer.name",
        "value.projection.list.urgent": "status,cents",
    })
    log = order_documents(spark, sf_dir)
    urgent = TargetPlan(settings, "urgent").folded(log.filter("value.urgent"))
    other = TargetPlan(settings, "other").folded(log.filter("NOT value.urgent"))
    count = lambda name, df, status, label, amount: df.agg(
        F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"), status.alias("has_status"),
        label.alias("has_name"), amount.alias("amount"),
    )
    zero = F.lit(0).cast("bigint")
    return count("urgent", urgent, F.sum(F.length("doc.status")), zero, F.sum("doc.cents")).unionByName(
        count("other", other, zero, F.count("doc.customer.name"), zero)
    )
