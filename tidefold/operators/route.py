"""From topics to targets.

Routes come from the settings, so they are literals of the plan: no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidefold.operators.scan import number_rows


def rewrite_topic(topic: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Rewrite topics that a pattern matches as a whole; rules apply in order."""
    for regex, replacement in rules:
        topic = F.when(topic.rlike(f"^(?:{regex})$"), F.regexp_replace(topic, f"^(?:{regex})$", replacement)).otherwise(
            topic
        )
    return topic


def target_of(topic: Column, routes: Mapping[str, str], default: str = "") -> Column:
    """Mapped target, else the default, else the topic's own name."""
    mapped = F.lit(None).cast("string")
    if routes:
        mapped = F.create_map(*[F.lit(x) for pair in sorted(routes.items()) for x in pair])[topic]
    present = lambda c: F.when(c != "", c)
    return F.coalesce(present(mapped), present(F.lit(default)), topic)


def namespace(target: Column, database: str, catalog: str = "") -> Column:
    """`database.target`, or `catalog::database.target` for row stores."""
    full = F.concat_ws(".", F.lit(database), target)
    return F.concat(F.lit(catalog + "::"), full) if catalog else full


def route(
    log: DataFrame, routes: Mapping[str, str], default: str = "", rewrites: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    return log.withColumn("target", target_of(rewrite_topic(F.col("topic"), rewrites), routes, default))


def number_batches(log: DataFrame, size: int, width: int = 1_000_000) -> DataFrame:
    """Add `batch`: consecutive records of a target in groups of `size` (0: one batch)."""
    if size <= 0:
        return log.withColumn("batch", F.lit(0).cast("bigint"))
    numbered = number_rows(log, ["target"], ["offset", "topic", "partition"], width)
    return numbered.withColumn("batch", F.call_function("div", F.col("rn"), F.lit(size).cast("bigint"))).drop("rn")
