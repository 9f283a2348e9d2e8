"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns whose expressions must not be repeated.

    Catalyst copies a projected expression into every filter and projection above
    it, so a parsed JSON text tested by five conditions is parsed six times.  The
    explode of a one-element array keeps its rows and stops that copying.
    """
    kept = [c for c in df.columns if c not in columns]
    parts = F.struct(*[c.alias(n) for n, c in columns.items()])
    once = df.select(*kept, F.explode(F.array(parts)).alias("_once"))
    return once.select(
        *[F.col("_once").getField(c).alias(c) if c in columns else F.col(c) for c in df.columns],
        *[F.col("_once").getField(c).alias(c) for c in columns if c not in df.columns],
    )
