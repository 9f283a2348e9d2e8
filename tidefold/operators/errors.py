"""Bad records: abort the job, or route them aside with a reason code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidefold.functions.once import compute_once

ERR = "err"


def first_error(*conditions: tuple[Column, str]) -> Column:
    """Reason code of the first condition that holds, else null."""
    whens = reduce(
        lambda acc, c: acc.when(c[0], F.lit(c[1])) if acc is not None else F.when(c[0], F.lit(c[1])),
        conditions,
        None,
    )
    return F.lit(None).cast("string") if whens is None else whens


def add_error(df: DataFrame, code: Column) -> DataFrame:
    """Keep the earliest reason when several steps find fault with a record."""
    known = F.col(ERR) if ERR in df.columns else F.lit(None).cast("string")
    return df.withColumn(ERR, F.coalesce(known, code))


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col(ERR).isNull()).drop(ERR) if ERR in df.columns else df


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(ERR).isNotNull()) if ERR in df.columns else df.limit(0)


def fail_fast(df: DataFrame) -> DataFrame:
    """Abort the job at the first bad record."""
    if ERR not in df.columns:
        return df
    # the code is settled first: merged with the filters that skip records, the test could run ahead of them
    df = compute_once(df, **{ERR: F.col(ERR)})
    keep = F.when(F.col(ERR).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("bad record: "), F.col(ERR))).cast("boolean")
    )
    return df.filter(keep).drop(ERR)


def settle(df: DataFrame, mode: str) -> DataFrame:
    """The good rows, under the given error mode (`failfast` or `reject`)."""
    if mode == "failfast":
        return fail_fast(df)
    if mode == "reject":
        return good(df)
    raise ValueError(f"unknown error mode {mode!r}")
