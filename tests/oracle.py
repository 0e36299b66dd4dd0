"""Compares a Spark result with DuckDB's on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(d: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """None if both sides hold the same columns and the same rows, else what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    order = sorted(names)
    left = Counter(tuple(_plain(r[c]) for c in order) for r in spark_df.collect())
    at = [names.index(c) for c in order]
    right = Counter(tuple(_plain(r[i]) for i in at) for r in expected)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; "
        f"only Spark {list(only_left)[:3]}; only SQL {list(only_right)[:3]}"
    )


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v
