"""Tables without a primary key: changes matched by the whole row image.

Each update or delete touches one row equal to its before image, so the outcome
only depends on how often an image was added and taken away:
n = initial + afters - befores.  Counts combine on the map side, so a hot image
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidefold.functions import jsontext
from tidefold.model import field, log_position, struct_type
from tidefold.operators import evolve
from tidefold.operators.cdc_relational import CREATE, READ, REMOVE, UPDATE, check_op, op_code, skip_tombstones
from tidefold.operators.errors import add_error

COUNT = "n"


def image_changes(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per image a change event adds (+1) or takes away (-1)."""
    df = skip_tombstones(log)
    op, value = op_code(df), F.col("value")

    def side(name: str, n: int, codes: Sequence[str]):
        image = field(value, name)
        row = F.struct(*[field(image, c).alias(c) for c in columns], F.lit(n).cast("bigint").alias(COUNT))
        return F.when(op.isin(*codes) & image.isNotNull(), row)

    sides = F.filter(
        F.array(side("before", -1, ["u", "d"]), side("after", 1, ["c", "r", "u"])), lambda x: x.isNotNull()
    )
    return df.select(F.explode(sides).alias("s")).select("s.*")


def image_ops(log: DataFrame) -> DataFrame:
    """Images that change events add and take away, with the reason of bad records: k, doc, n, err.

    `k` stands for the image: 128 bits of a hash of its canonical text without nulls, so that new columns do not change it.
    """
    df = skip_tombstones(log)
    op, value = op_code(df), F.col("value")
    df = check_op(df, op, (CREATE, READ, UPDATE, REMOVE))
    before, after = field(value, "before"), field(value, "after")
    dtype = struct_type(df, "value")["after"].dataType
    empty = lambda image: image.isNull() | ~F.greatest(F.lit(False), F.lit(False), *[field(image, f.name).isNotNull() for f in dtype.fields])
    takes, gives = op.isin(UPDATE, REMOVE), op.isin(CREATE, READ, UPDATE)
    df = add_error(df, F.when(takes & empty(before), F.lit("before is missing or empty")).when(
        gives & empty(after), F.lit("after is missing or empty")))
    image = lambda side: F.struct(*[field(side, f.name).alias(f.name) for f in dtype.fields])
    one = lambda side, n: F.struct(image(side).alias("doc"), F.lit(n).cast("bigint").alias(COUNT))
    bad = F.col("err").isNotNull()
    sides = F.array(F.when(bad | takes, one(before, -1)), F.when(gives & ~bad, one(after, 1)))
    sides = F.filter(sides, lambda s: s.isNotNull())
    rows = df.select(*log_position(df), "err", F.explode(sides).alias("s"))
    hashed = F.unhex(F.substring(F.sha2(jsontext.struct_text(F.col("s.doc"), dtype, nulls=False), 256), 1, 32))
    return rows.select(*log_position(df), hashed.alias("k"), "s.doc", f"s.{COUNT}", "err")


def fold_images(ops: DataFrame) -> DataFrame:
    """One row per image, with what is added to its count; images that come out even are gone.  `k` becomes text."""
    left = ops.groupBy("k").agg(F.first("doc").alias("doc"), F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)
    return left.withColumn("k", F.substring(F.base64("k"), 1, 22))  # less the padding


def merge_images(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Images of a target with their counts after the changes, and `err` where more are taken away than there are."""
    want = evolve.wider(target.schema["doc"].dataType, delta.schema["doc"].dataType)
    fitted = lambda df: df.select("k", evolve.fit(F.col("doc"), df.schema["doc"].dataType, want).alias("doc"), COUNT)
    both = fitted(target).unionByName(fitted(delta)).groupBy("k").agg(F.first("doc").alias("doc"), F.sum(COUNT).alias(COUNT))
    return both.withColumn("err", F.when(F.col(COUNT) < 0, F.lit("image is not there"))).filter(F.col(COUNT) != 0)


def bad_images(log: DataFrame) -> DataFrame:
    """Updates and deletes without a before image, with their log position."""
    df = skip_tombstones(log)
    before = field(F.col("value"), "before")
    return df.filter(op_code(df).isin("u", "d") & before.isNull()).select(
        "topic", "partition", "offset", F.lit("before is missing or empty").alias("err")
    )


def net(initial: DataFrame, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Images with the number of rows that equal them afterwards."""
    start = initial.select(*columns, F.lit(1).cast("bigint").alias(COUNT))
    return (
        start.unionByName(changes.select(*columns, COUNT))
        .groupBy(*columns)
        .agg(F.sum(COUNT).alias(COUNT))
    )


def rows(netted: DataFrame, columns: Sequence[str], per_row: int = 10_000) -> DataFrame:
    """Each image as many times as it is left.

    The repeats are generated in two steps, so that a very frequent image is
    neither one huge array nor the work of one task.
    """
    left = netted.filter(F.col(COUNT) > 0)
    chunks = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col(COUNT) - 1, F.lit(per_row)))
    spread = left.withColumn("chunk", F.explode(chunks))
    frequent = F.col(COUNT) > per_row
    size = F.least(F.lit(per_row).cast("bigint"), F.col(COUNT) - F.col("chunk") * per_row)
    expand = lambda df: df.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_i")).drop("_i")
    hot = spread.filter(frequent).repartition(*[F.col(c) for c in columns], F.col("chunk"))
    return expand(spread.filter(~frequent)).unionByName(expand(hot))


def inconsistent(netted: DataFrame) -> DataFrame:
    """Images taken away more often than they existed."""
    return netted.filter(F.col(COUNT) < 0)
