"""Projection and renaming on golden documents."""

import json

import pytest
from pyspark.sql import functions as F

from tidefold.operators import project as prj, rename as ren

# an order with its customer, and a parcel with its stops
KEY = "_id string, region int, buyer struct<mail:string,trusted:boolean>, payer struct<mail:string,trusted:boolean>"
KEY_ROW = ("o-17", 3, ("ann@x", False), ("bob@x", True))
VALUE = (
    "_id string, paid boolean, "
    "parcel struct<carrier:string,kilos:double,label:struct<code:string,copies:int,glued:boolean>>, "
    "refund struct<carrier:string,kilos:double,label:struct<scan:string,stops:array<struct<town:string,hour:int>>>>"
)
STOPS = [("Graz", 7), ("Brno", 19)]
VALUE_ROW = ("p-4", True, ("mule", 2.5, ("LX", 2, False)), ("ship", 0.75, ("s9", STOPS)))

BUYER = {"mail": "ann@x", "trusted": False}
PAYER = {"mail": "bob@x", "trusted": True}
LABEL = {"code": "LX", "copies": 2, "glued": False}
TOWNS = [{"town": "Graz", "hour": 7}, {"town": "Brno", "hour": 19}]
SCAN = {"scan": "s9", "stops": TOWNS}
MULE = {"carrier": "mule", "kilos": 2.5}
SHIP = {"carrier": "ship", "kilos": 0.75}
WHOLE_VALUE = {"_id": "p-4", "paid": True, "parcel": {**MULE, "label": LABEL}, "refund": {**SHIP, "label": SCAN}}


def project(spark, schema, row, kind, rules):
    df = spark.createDataFrame([row], schema).select(F.struct("*").alias("value"))
    out = prj.project(df, "value", prj.projection(kind, rules), keep_empty=True)
    return json.loads(out.select(F.to_json("value").alias("j")).first()["j"])


# expected from the rules: a blacklist drops what a path names, `*` for any plain field on its level (also on
# the way to a deeper name), `**` for all
# below it; a whitelist keeps named fields only, its parents must be named as well; _id always stays
KEY_CASES = [
    ("none", "", {"_id": "o-17", "region": 3, "buyer": BUYER, "payer": PAYER}),
    ("blacklist", "_id,payer.mail", {"_id": "o-17", "region": 3, "buyer": BUYER, "payer": {"trusted": True}}),
    ("blacklist", "*", {"_id": "o-17", "buyer": BUYER, "payer": PAYER}),
    ("blacklist", "**", {"_id": "o-17"}),
    ("blacklist", "region,*.trusted", {"_id": "o-17", "buyer": {"mail": "ann@x"}, "payer": {"mail": "bob@x"}}),
    ("blacklist", "buyer.*", {"_id": "o-17", "region": 3, "buyer": {}, "payer": PAYER}),
    ("WhiteList", "", {"_id": "o-17"}),
    ("whitelist", "*", {"_id": "o-17", "region": 3, "buyer": {}, "payer": {}}),
    ("whitelist", "payer,payer.mail", {"_id": "o-17", "payer": {"mail": "bob@x"}}),
    ("whitelist", "**", {"_id": "o-17", "region": 3, "buyer": BUYER, "payer": PAYER}),
]
VALUE_CASES = [
    ("blacklist", "_id,refund", {"_id": "p-4", "paid": True, "parcel": {**MULE, "label": LABEL}}),
    ("blacklist", "**", {"_id": "p-4"}),
    ("blacklist", "parcel,refund.label", {"_id": "p-4", "paid": True, "refund": SHIP}),
    ("blacklist", "*,refund.*", {"_id": "p-4", "parcel": {**MULE, "label": LABEL}, "refund": {"label": SCAN}}),
    ("blacklist", "paid,parcel.**", {"_id": "p-4", "parcel": {}, "refund": {**SHIP, "label": SCAN}}),
    ("blacklist", "*.label", {"_id": "p-4", "parcel": MULE, "refund": SHIP}),
    ("blacklist", "parcel.*.copies,refund.label.*",
     {"_id": "p-4", "paid": True, "parcel": {"label": {"code": "LX", "glued": False}}, "refund": {**SHIP, "label": {}}}),
    ("blacklist", "parcel,refund.carrier,refund.kilos,refund.label.scan,refund.label.stops.hour",
     {"_id": "p-4", "paid": True, "refund": {"label": {"stops": [{"town": "Graz"}, {"town": "Brno"}]}}}),
    ("whitelist", "", {"_id": "p-4"}),
    ("whitelist", "*", {"_id": "p-4", "paid": True, "parcel": {}, "refund": {}}),
    ("whitelist", "refund,refund.kilos,parcel,parcel.**",
     {"_id": "p-4", "parcel": {**MULE, "label": LABEL}, "refund": {"kilos": 0.75}}),
    ("whitelist", "**", WHOLE_VALUE),
    ("whitelist", "refund,refund.label,refund.label.stops,refund.label.stops.town",
     {"_id": "p-4", "refund": {"label": {"stops": [{"town": "Graz"}, {"town": "Brno"}]}}}),
]


@pytest.mark.parametrize("kind,rules,expected", KEY_CASES)
def test_nested_key(spark, kind, rules, expected):
    assert project(spark, KEY, KEY_ROW, kind, rules) == expected


@pytest.mark.parametrize("kind,rules,expected", VALUE_CASES)
def test_nested_value(spark, kind, rules, expected):
    assert project(spark, VALUE, VALUE_ROW, kind, rules) == expected


FLAT = "_id string, stock bigint, price double, title string, tags array<string>"
FLAT_ROW = ("b-2", 11, 7.25, "Pen", [])
FLAT_DOC = {"_id": "b-2", "stock": 11, "price": 7.25, "title": "Pen", "tags": []}


@pytest.mark.parametrize("kind,rules,kept", [
    ("blacklist", "", FLAT_DOC),
    ("blacklist", "*", ["_id"]),
    ("blacklist", "**", ["_id"]),
    ("blacklist", "_id", FLAT_DOC),
    ("blacklist", "price,tags", ["_id", "stock", "title"]),
    ("blacklist", "colour", FLAT_DOC),
    ("whitelist", "*", FLAT_DOC),
    ("whitelist", "**", FLAT_DOC),
    ("whitelist", "_id", ["_id"]),
    ("whitelist", "title,tags", ["_id", "title", "tags"]),
    ("whitelist", "colour", ["_id"]),
])
def test_flat(spark, kind, rules, kept):
    assert project(spark, FLAT, FLAT_ROW, kind, rules) == {k: FLAT_DOC[k] for k in kept}


LISTS = (
    "shop string, floor int, open boolean, place struct<street:string,door:string>, langs array<string>, "
    "shelves array<struct<no:string,books:int>>, rates map<string,double>"
)
LISTS_ROW = ("Quill", 2, False, ("Elm St", "4b"), ["cs", "sl"], [("A", 90)], {"eur": 1.5, "chf": 1.25})


def test_lists_with_maps_and_arrays(spark):
    rules = "floor,place.door,rates.chf,shelves.books"
    assert project(spark, LISTS, LISTS_ROW, "blacklist", rules) == {
        "shop": "Quill", "open": False, "place": {"street": "Elm St"}, "langs": ["cs", "sl"],
        "shelves": [{"no": "A"}], "rates": {"eur": 1.5},
    }
    assert project(spark, LISTS, LISTS_ROW, "whitelist", rules) == {
        "floor": 2, "place": {"door": "4b"}, "shelves": [{"books": 90}], "rates": {"chf": 1.25},
    }


def test_map_of_documents(spark):
    schema = "m map<string,struct<x:int,y:int>>"
    row = ({"a": (1, 2), "b": (3, 4)},)
    assert project(spark, schema, row, "blacklist", "m.*.x") == {"m": {"a": {"y": 2}, "b": {"y": 4}}}
    # one key's documents cannot lose a field the others keep: it becomes null
    assert project(spark, schema, row, "blacklist", "m.a.x") == {"m": {"a": {"y": 2}, "b": {"x": 3, "y": 4}}}
    assert project(spark, schema, row, "whitelist", "m.b.y") == {"m": {"b": {"y": 4}}}


def test_whitelist_lists_parents():
    assert prj.Whitelist.of("a.b.c, d").paths == {("a",), ("a", "b"), ("a", "b", "c"), ("d",)}


def test_unknown_projection():
    with pytest.raises(ValueError):
        prj.projection("greylist", "a")


# -- renaming ---------------------------------------------------------------

REN_SCHEMA = (
    "key struct<shopNo:string,live:boolean,till:struct<slotNo:int>,old_code:struct<old_part:string>>, "
    "value struct<nm:string,live:boolean,tax:struct<`19`:double>,`a.b`:struct<`c.d`:int>>"
)
REN_ROW = (("n7", True, (5,), ("q",)), ("hat", False, (0.5,), (8,)))


def renamed(spark, renamer):
    df = ren.rename(spark.createDataFrame([REN_ROW], REN_SCHEMA), renamer)
    return [json.loads(t) for t in df.select(F.to_json("key"), F.to_json("value")).first()]


def test_rename_by_mapping(spark):
    names = {"key.shopNo": "shop", "key.live": "is_live", "key.till.slotNo": "slot", "value.nm": "name", "value.tax.19": "high"}
    key, value = renamed(spark, ren.ByMapping(names))
    assert key == {"shop": "n7", "is_live": True, "till": {"slot": 5}, "old_code": {"old_part": "q"}}
    assert value == {"name": "hat", "live": False, "tax": {"high": 0.5}, "a.b": {"c.d": 8}}


def test_rename_by_regexp(spark):
    rules = [
        ren.NameRule(r"^key\..*old.*$", "old_", ""), ren.NameRule(r"^key\..*No$", "No", "Number"),
        ren.NameRule(r"^value\..*$", r"\.", "-"),
    ]
    key, value = renamed(spark, ren.ByRegExp(rules))
    assert key == {"shopNumber": "n7", "live": True, "till": {"slotNumber": 5}, "code": {"part": "q"}}
    assert value == {"nm": "hat", "live": False, "tax": {"19": 0.5}, "a-b": {"c-d": 8}}


def test_rename_keeps_taken_names():
    assert ren.free_names(["a", "b", "c"], ["b", "x", "x"]) == ["a", "x", "c"]


def test_rename_map_keys(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2, "c": 3, "d": 4},)], "m map<string,int>").select(F.struct("m").alias("value"))
    # b is taken, x is wanted twice, e is free
    names = ren.ByMapping({"value.m.a": "b", "value.m.b": "x", "value.m.c": "x", "value.m.d": "e"})
    assert ren.rename(df, names, ["value"]).first()["value"]["m"] == {"a": 1, "b": 2, "c": 3, "e": 4}


def test_lower_case_clash(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'A', 2) AS value")
    with pytest.raises(ValueError):
        ren.lower_case(df, "value")
