"""Row-for-row comparison of a Spark query with its SQL in DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    res = con.sql(sql)
    if sorted(res.columns) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(res.columns)}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(res.columns, res.fetchall())
    if ours == theirs:
        return None if ours else "no rows on either side"
    a, b = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"rows: spark {sum(ours.values())} sql {sum(theirs.values())}\n only spark {a}\n only sql {b}"
