"""Data-quality reports. Each is one partially aggregated pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import percent


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table, n) row per named table."""
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in tables.items()]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share per class, NULL included."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), _total(counts, "n"), 2)).orderBy(column)


def flag_totals(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Sum of each 0/1 column under its output name."""
    return df.agg(*[F.sum(c).alias(name) for c, name in flags.items()])


def rate_by(df: DataFrame, by: str, flag: str) -> DataFrame:
    """How often ``flag`` is set per class: events, total and percentage."""
    return (
        df.groupBy(by).agg(F.sum(flag).alias("events"), F.count("*").alias("total"))
        .withColumn("rate_pct", percent(F.col("events"), F.col("total"), 2))
        .orderBy(by)
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a ``<column>_null`` count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns])


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have missing values, worst first, with count and percentage of all rows."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        counted.unpivot(["_rows"], df.columns, "column", "nulls")
        .where(F.col("nulls") > 0)
        .select("column", "nulls", percent(F.col("nulls"), F.col("_rows"), 1).alias("pct"))
        .orderBy(F.desc("nulls"), "column")
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count per non-missing value, most frequent first; shares refer to all rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    return (
        counts.withColumn("pct", percent(F.col("count"), _total(counts, "count"), 2))
        .where(F.col(column).isNotNull())
        .orderBy(F.desc("count"), column)
    )


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _total(counts: DataFrame, column: str) -> Column:
    """The grand total as a scalar subquery: unlike a window over everything it needs no single task."""
    return counts.agg(F.sum(column)).scalar()
