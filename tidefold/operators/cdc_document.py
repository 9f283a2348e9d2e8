"""Change events of document sources: JSON texts in `after` and `patch`.

Operations come out in the JSON lane: `k` is the canonical JSON text of the id,
`sets` the fields written (name to JSON text), `unsets` the fields removed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidefold.functions import jsontext
from tidefold.functions.once import compute_once
from tidefold.model import DELETE, ID, LOG_POSITION, REPLACE, SET, field, log_ord, log_position, struct_type
from tidefold.operators.cdc_relational import CREATE, READ, REMOVE, UPDATE, check_op, op_code
from tidefold.operators.errors import add_error

# fixed values: names in the patches of document change events
VERSION_MARK = "$v"
PATCH_SET, PATCH_UNSET = "$set", "$unset"
HANDLED = (CREATE, READ, UPDATE, REMOVE)


def key_id(df: DataFrame) -> Column:
    """JSON text of the id held in the key, null when the key has no such text."""
    ktype = struct_type(df, "key")
    if ktype is None or "id" not in ktype.names or ktype["id"].dataType.simpleString() != "string":
        return F.lit(None).cast("string")
    return field(F.col("key"), "id")


def skip_tombstones(log: DataFrame) -> DataFrame:
    """Drop records with a key and no value; a record without key is bad."""
    log = add_error(log, F.when(F.col("key").isNull(), F.lit("key is missing")))
    return log.filter(F.col("err").isNotNull() | F.col("value").isNotNull())


def document_ops(
    log: DataFrame, target: str = "document", handled: Mapping[str, object] | tuple = HANDLED
) -> DataFrame:
    """Operations of a document log for a `document` or a `row` target.

    A patch that holds `_id` replaces the document.  Other patches change the fields
    they list and do nothing where the document is missing.  Document targets drop
    unset fields, row targets null them.
    """
    df = skip_tombstones(log)
    op = op_code(df)
    df = check_op(df, op, list(handled))
    value = F.col("value")

    text = F.when(op.isin(CREATE, READ), field(value, "after")).when(op == UPDATE, field(value, "patch"))
    df = df.select(*log_position(df), "err", op.alias("code"), key_id(df).alias("key_id"), text.alias("body"))
    df = compute_once(
        df, key_id=jsontext.canonical(F.col("key_id")), body=jsontext.members(jsontext.parse(F.col("body")))
    )

    body, code = F.col("body"), F.col("code")
    patched = (code == UPDATE) & body.isNotNull() & ~F.coalesce(F.map_contains_key(body, ID), F.lit(False))
    written = F.when(patched, jsontext.members(body[PATCH_SET])).otherwise(
        F.map_filter(body, lambda k, _: k != VERSION_MARK)
    )
    df = compute_once(
        df,
        is_object=body.isNotNull(),
        patch=patched,
        doc_id=F.to_json(body[ID]),
        fields=jsontext.texts(written),
        gone=F.when(patched, F.map_keys(jsontext.members(body[PATCH_UNSET]))),
    ).drop("body")
    is_object, is_set = F.col("is_object"), F.coalesce("patch", F.lit(False))
    df = add_error(
        df,
        F.when(code.isin(CREATE, READ) & ~is_object, F.lit("after is no JSON object"))
        .when(code.isin(CREATE, READ) & F.col("doc_id").isNull(), F.lit("after holds no _id"))
        .when((code == UPDATE) & ~is_object, F.lit("patch is no JSON object"))
        .when(((code == REMOVE) | is_set) & F.col("key_id").isNull(), F.lit("key id is no JSON text")),
    )

    none, no_names = F.create_map().cast("map<string,string>"), F.array().cast("array<string>")
    sets = F.when(code == REMOVE, none).otherwise(F.coalesce("fields", none))
    unsets = F.coalesce("gone", no_names)
    if target == "row":
        # a field both set and unset keeps what was set
        fresh = F.filter(unsets, lambda n: ~F.map_contains_key(sets, n))
        nulls = F.map_from_arrays(fresh, F.transform(fresh, lambda _: F.lit("null")))
        sets, unsets = F.when(F.size(fresh) > 0, F.map_concat(sets, nulls)).otherwise(sets), no_names
    return df.select(
        *LOG_POSITION,
        F.when(is_set | (code == REMOVE), F.col("key_id")).otherwise(F.col("doc_id")).alias("k"),
        F.when(code == REMOVE, F.lit(DELETE)).when(is_set, F.lit(SET)).otherwise(F.lit(REPLACE)).alias("op"),
        (~is_set & (code != REMOVE)).alias("upsert"),
        sets.alias("sets"),
        unsets.alias("unsets"),
        log_ord(log=df).alias("ord"),
        "err",
    )


def delete_insert_pairs(ops: DataFrame) -> DataFrame:
    """Each replacement as a delete and an insert of the same record, in this order.

    Row stores have no replace; folding the pair gives what folding the replace does.
    """
    is_replace = F.col("op") == REPLACE
    none = F.create_map().cast("map<string,string>")
    place = lambda sub: F.struct(F.col("ord")["offset"].alias("offset"), F.lit(sub).alias("sub"))
    one = lambda op, sets, ord_: F.struct(op.alias("op"), sets.alias("sets"), ord_.alias("ord"))
    parts = F.when(
        is_replace,
        F.array(one(F.lit(DELETE), none, place(0)), one(F.lit(REPLACE), F.col("sets"), place(1))),
    ).otherwise(F.array(one(F.col("op"), F.col("sets"), F.col("ord"))))
    rest = [c for c in ops.columns if c not in ("op", "sets", "ord")]
    return ops.select(*rest, F.explode(parts).alias("_p")).select(*rest, "_p.*")
