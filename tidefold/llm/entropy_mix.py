"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Targets.  Sources, in code point order with null last, weigh 1, 2, 3, repeating (or as given),
and share all words by weight; a target stops at `most` times its source's size, and the excess
is reshared by weight until none is above.  With a common level t every open source gets
weight * t, so resharing is a search for t.

Rates.  Of all ways to take documents at rates r >= 0, r <= `most`, whose words meet the targets,
entropy balancing takes the one nearest to the base rates q:

    minimise  sum size * (r * ln(r / q) - r + q)   subject to   sum size * r = target  per source

Its dual is convex, with one multiplier per source, and its optimum is an exponential tilt
r = min(most, q * exp(lambda)).  Newton steps lambda += (target - taken) / slope, the sums over
all documents taken anew for each step, until every source is within `tolerance`.  Where no
document is at its bound the slope is what is taken.  Documents enter the sums as counts of
equal (source, cell, base rate), so a step reads a small table and no source is gathered.

Copies.  Rates become whole copies: sizes are put in cells (1 to 64 words singly, then 1% wide).
From the largest cell down, each cell's copies are what brings the words taken so far nearest to
the words wanted so far, so errors of large documents are made up by small ones.  A cell's copies
are dealt evenly over its documents; what does not divide goes to those of the least hashes, of rows alike
to as many as are left over, by their numbers in a stored table.  The
hash of the last one is found by counts over ranges of the hash, so no source and no cell is in
one task, and texts are not shuffled.  No document has more than `most` copies.

Cases: a null text has no words and is not taken; a null source is a source, the last one; rows
that repeat another's id, source and text are documents each, and may be taken once more or less than it; empty tables
give no rows; a source without words has target 0; columns with clashing names are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidefold.functions.once import compute_once
from tidefold.llm.choose import small
from tidefold.sinks.folders import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
WEIGHTS = (1.0, 2.0, 3.0)
TOLERANCE = 1e-9
STEPS = 60


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, computed once."""
    spark: SparkSession = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _cell(size: Column) -> Column:
    """Sizes up to 64 singly, then 1% wide."""
    wide = F.floor(F.log(size / F.lit(64.0)) / F.lit(0.01)).cast("long") + 65
    return F.when(size <= 64, size).otherwise(wide)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source_size and target per source, from one row (source, source_size) per source."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    df = _kept(sizes.withColumn("weight", weight), "mix-sources")
    total = df.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * float(most)
    level, full = 0.0, -1
    while True:  # each turn closes one source at least
        shut = cap <= F.col("weight") * level
        closed, kept, weight = df.agg(
            F.sum(shut.cast("long")), F.sum(F.when(shut, cap)), F.sum(F.when(~shut, F.col("weight")))
        ).first()
        if not weight or closed == full:
            break
        level, full = (total - (kept or 0.0)) / weight, closed
    return df.withColumn("target", F.least(cap, F.col("weight") * level)).drop("weight")


def rates(cells: DataFrame, goals: DataFrame, most: float = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """lambda per source, from cells (source, base, words) and goals (source, source_size, target)."""
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # where the bound is met by all documents no finite multiplier is
    start = F.when(F.col("target") >= F.col("source_size") * float(most), F.lit(float("inf"))).otherwise(F.lit(0.0))
    now = goals.select("source", "target", start.alias("tilt"), F.lit(float("-inf")).alias("low"),
                       F.lit(float("inf")).alias("high"))
    for _ in range(STEPS):
        rate = F.least(F.lit(float(most)), F.col("base") * F.exp("tilt"))
        held = F.col("base") * F.exp("tilt") >= float(most)
        sums = cells.join(now.select(F.col("source").alias("s"), "tilt"), F.col("source").eqNullSafe(F.col("s")))
        sums = sums.groupBy("source").agg(
            F.sum(F.col("words") * rate).alias("taken"),
            F.sum(F.when(~held, F.col("words") * rate)).alias("slope"),
        )
        step = now.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        miss = F.col("target") - F.coalesce("taken", F.lit(0.0))
        low = F.when(miss > 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(miss < 0, F.least("high", "tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.greatest(F.lit(-4.0), F.least(F.lit(4.0), miss / F.col("slope")))
        inside = F.col("slope").isNotNull() & (newton > low) & (newton < high)
        middle = F.when((low > float("-inf")) & (high < float("inf")), (low + high) / 2)
        middle = middle.otherwise(F.col("tilt") + F.when(miss > 0, 1.0).otherwise(-1.0))
        done = (F.abs(miss) <= F.greatest(F.lit(1.0), F.col("target")) * tolerance) | F.col("tilt").eqNullSafe(float("inf"))
        done = done | (F.col("target") <= 0) | F.coalesce("taken", F.lit(0.0)).eqNullSafe(0.0)
        tilt = F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle)
        now = _kept(step.select("source", "target", tilt.alias("tilt"), low.alias("low"), high.alias("high"),
                                done.alias("done")), "mix-tilt")
        if now.filter(~F.col("done")).isEmpty():
            break
        now = now.drop("done")
    # rounded, so that sums in another order give the same mix
    return now.select("source", F.round("tilt", 10).alias("tilt"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, base: Column | None = None, name: str = "mix"
) -> DataFrame:
    """All columns of `docs`, and a struct `name` of size, source_size, target, rate and copies.

    `base` are base rates by which some documents are preferred (positive; none: 1 each).
    """
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name!r}: choose another name")
    p = "_" * (1 + max(map(len, docs.columns)))  # names that no column has
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = compute_once(docs, **{f"{p}size": size})
    rows = rows.withColumns({
        f"{p}cell": _cell(F.col(f"{p}size")), f"{p}order": F.xxhash64("doc_id", "source", F.xxhash64("text")),
        f"{p}base": (base if base is not None else F.lit(1.0)).cast("double"),
    })
    # measured once, without the texts
    facts = _kept(rows.select("source", *[F.col(p + c).alias(c) for c in ("size", "cell", "order", "base")]), "mix-sizes")
    sizes = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = _kept(targets(sizes, weights, most), "mix-targets")
    hist = facts.groupBy("source", "cell", "base").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    hist = _kept(hist, "mix-cells")
    deal = small(_deal(facts, _copies(hist, rates(hist, goals, most), most)))
    deal = deal.select(*[F.col(c).alias(f"{p}{p}{c}") for c in deal.columns])
    goals = small(goals).select(*[F.col(c).alias(f"{p}{p}{p}{c}") for c in goals.columns])
    out = rows.join(goals, F.col("source").eqNullSafe(F.col(f"{p}{p}{p}source")), "left")
    same = F.col("source").eqNullSafe(F.col(f"{p}{p}source")) & (F.col(f"{p}cell") == F.col(f"{p}{p}cell"))
    same = same & (F.col(f"{p}base") == F.col(f"{p}{p}base"))
    out = out.join(deal, same, "left")
    more = F.coalesce((F.col(f"{p}order") <= F.col(f"{p}{p}last")).cast("long"), F.lit(0))

    def told(rows: DataFrame, more: Column) -> DataFrame:
        facts_ = F.struct(
            F.col(f"{p}size").alias("size"), F.col(f"{p}{p}{p}source_size").alias("source_size"), F.col(f"{p}{p}{p}target").alias("target"),
            F.col(f"{p}{p}rate").alias("rate"), (F.col(f"{p}{p}each") + more).alias("copies"))
        return rows.select(facts_.alias(name), *[F.col(f"`{c}`") for c in docs.columns])

    if deal.filter(F.col(f"{p}{p}need") < F.col(f"{p}{p}ties")).isEmpty():
        return told(out, more)
    # rows alike, some of which are taken once more: they are numbered and dealt by the hashes of their numbers
    split = F.coalesce((F.col(f"{p}order") == F.col(f"{p}{p}last")) & (F.col(f"{p}{p}need") < F.col(f"{p}{p}ties")), F.lit(False))
    alike = _kept(out.filter(split).withColumn(f"{p}nth", F.monotonically_increasing_id()), "mix-alike")
    nth = F.xxhash64(f"{p}nth")
    again = alike.select("source", *[F.col(p + c).alias(c) for c in ("cell", "base")], nth.alias("order"))
    some = deal.filter(F.col(f"{p}{p}need") < F.col(f"{p}{p}ties"))
    some = some.select(*[F.col(f"{p}{p}{c}").alias(c) for c in ("source", "cell", "base", "rate")],
                       F.col(f"{p}{p}ties").alias("n"), F.col(f"{p}{p}need").alias("copies"))
    upto = small(_deal(again, some)).select(*[F.col(c).alias(f"{p}{p}{p}{p}{c}") for c in ("source", "cell", "base", "last")])
    same = [F.col(c).eqNullSafe(F.col(f"{p}{p}{p}{p}{n}")) for c, n in (("source", "source"), (f"{p}cell", "cell"), (f"{p}base", "base"))]
    alike = alike.join(upto, same, "left")
    dealt = (F.xxhash64(f"{p}nth") <= F.col(f"{p}{p}{p}{p}last")).cast("long")
    return told(out.filter(~split), more).unionByName(told(alike, dealt))


def _copies(hist: DataFrame, tilts: DataFrame, most: float) -> DataFrame:
    """(source, cell, base, n, rate, copies): whole copies of every cell, the largest cells first."""
    per = hist.join(tilts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("words") > 0, F.least(F.lit(float(most)), F.col("base") * F.exp("tilt"))).otherwise(0.0)
    per = per.withColumn("rate", rate)
    # the cells of a source: some thousand for any size of text (and each base rate)
    entry = F.struct("cell", "base", "n", "words", "rate")
    lists = per.groupBy("source").agg(F.sort_array(F.collect_list(entry), False).alias("cells"))

    def carry(acc: Column, c: Column) -> Column:
        want = c["words"] * c["rate"] + acc["over"]
        mean = c["words"] / c["n"]
        copies = F.greatest(F.lit(0.0), F.least(F.lit(float(most)) * c["n"], F.round(want / mean)))
        copies = F.when(c["words"] > 0, copies).otherwise(0.0)
        out = F.struct(c["cell"].alias("cell"), c["base"].alias("base"), c["n"].alias("n"), c["rate"].alias("rate"),
                       copies.cast("long").alias("copies"))
        return F.struct((want - copies * mean).alias("over"), F.concat(acc["out"], F.array(out)).alias("out"))

    none = F.array().cast("array<struct<cell:bigint,base:double,n:bigint,rate:double,copies:bigint>>")
    start = F.struct(F.lit(0.0).alias("over"), none.alias("out"))
    return _kept(lists.select("source", F.explode(F.aggregate("cells", start, carry)["out"]).alias("c")).select("source", "c.*"),
                 "mix-copies")


def _deal(facts: DataFrame, copies: DataFrame) -> DataFrame:
    """(source, cell, base, rate, each, last, need, ties): all documents of a cell are taken `each` times, those
    whose hash is below `last` once more, and `need` of the `ties` whose hash it is.

    `last` is the hash of a given rank in its cell: counts by range of the hash tell the range it lies in,
    and only that range is sorted.
    """
    spark = facts.sparkSession
    bits = 6 + max(1, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    facts = facts.withColumn("block", F.shiftright("order", 64 - bits))  # ranges of the hash, in its order
    key = ["source", "cell", "base"]
    each = F.floor(F.col("copies") / F.col("n")).cast("long")
    copies = copies.withColumn("each", each).withColumn("rest", F.col("copies") - F.col("each") * F.col("n"))
    match = lambda left, names: [F.col(left + c).eqNullSafe(F.col(c)) for c in names]
    named = lambda df, names: df.select(*[F.col(c).alias("x_" + c) if c in names else F.col(c) for c in df.columns])
    totals = facts.groupBy(*key, "block").agg(F.count("*").alias("in_block"))
    before = F.sum("in_block").over(Window.partitionBy(*key).orderBy("block")) - F.col("in_block")
    totals = named(totals.withColumn("before", before), key)
    some = copies.filter("rest > 0").select(*key, "rest")
    chosen = totals.join(some, match("x_", key)).filter("before < rest and rest <= before + in_block")
    chosen = named(chosen.select(*key, "block", "before", "rest"), [*key, "block"])
    rows = facts.join(chosen, match("x_", [*key, "block"])).groupBy(*key, "order", "before", "rest").agg(F.count("*").alias("ties"))
    upto = F.sum("ties").over(Window.partitionBy(*key).orderBy("order")) + F.col("before")
    rows = rows.withColumn("need", F.col("rest") - (upto - F.col("ties"))).filter("0 < need and need <= ties")
    last = named(rows.select(*key, F.col("order").alias("last"), "need", "ties"), key)
    return copies.join(last, match("x_", key), "left").select(*key, "rate", "each", "last", "need", "ties")


def take(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`."""
    free = "_" * (1 + max(map(len, docs.columns)))
    mixed = mix(docs, weights, most, name=free).filter(F.col(f"{free}.copies") > 0)
    again = F.sequence(F.lit(1), F.col(f"{free}.copies").cast("int"))
    return mixed.select("*", F.explode(again).alias(free + "copy")).select(*[F.col(f"`{c}`") for c in docs.columns])
