"""Statistics fitted on training rows; each result has one entry per column or class."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import SLICE_ROWS, running_totals
from .sampling import class_counts

# Ranks are estimated with an error of 1 / ACCURACY of the rows; a bracket of twice that holds the median.
ACCURACY = 10_000


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact interpolated median per column, None for a column without values."""
    if not columns:
        return {}
    found = {r["column"]: r["median"] for r in distributed_medians(df, columns).collect()}
    return {c: found.get(c) for c in columns}


def fills_and_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Median, and mean and population standard deviation after filling with it, for each column with a value.

    Two passes: the one that brackets the medians also takes the moments of the values that are there, to
    which the filled ones are then added by formula.
    """
    if not columns:
        return {}
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    row = doubles.agg(
        F.count("*").alias("n"), *[_bracket(c).alias(f"b_{k}") for k, c in enumerate(columns)],
        *[f(c).alias(f"{name}_{k}") for k, c in enumerate(columns) for name, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))],
    ).first()
    brackets = {c: row[f"b_{k}"] for k, c in enumerate(columns)}
    found = {r["column"]: r["median"] for r in _between(doubles, brackets, SLICE_ROWS).collect()}
    result = {}
    for k, c in enumerate(columns):
        if found.get(c) is None:
            continue
        n, there, mean, variance = row["n"], row[f"n_{k}"], row[f"m_{k}"], row[f"v_{k}"]
        gap, missing = found[c] - mean, n - there
        spread = (there * variance + gap * gap * there * missing / n) / n
        result[c] = found[c], mean + gap * missing / n, math.sqrt(spread) or 1.0
    return result


def _bracket(column: str) -> Column:
    around = F.array(*[F.lit(0.5 + side * 2 / ACCURACY) for side in (-1, 1)])
    return F.approx_percentile(column, around, ACCURACY)


def distributed_medians(df: DataFrame, columns: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(column, median) in two passes over the data.

    The first brackets every median between two estimated quantiles. The second counts the values below
    each bracket and, per distinct value, those inside, which are few; running counts over these find
    the one or two middle values exactly.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    brackets = doubles.agg(*[_bracket(c).alias(c) for c in columns]).first()
    return _between(doubles, brackets.asDict(), slice_rows)


def _between(doubles: DataFrame, brackets: dict, slice_rows: int) -> DataFrame:
    df = doubles
    known = [c for c in doubles.columns if brackets[c]]
    # What lies below or above a bracket is counted as one value.
    placed = [
        F.when(F.col(c) < F.lit(brackets[c][0]), F.lit(float("-inf")))
        .when(F.col(c) > F.lit(brackets[c][1]), F.lit(float("inf"))).otherwise(F.col(c)).alias(c)
        for c in known
    ]
    counted = (
        doubles.select(*placed).unpivot([], known, "column", "value").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    ) if known else df.sparkSession.createDataFrame([], "column string, value double, n long")
    ranks = running_totals(counted, "value", ["n"], within=["column"], slice_rows=slice_rows)
    # Ranks (from 1) of the one or two middle values.
    low = F.floor((F.col("total_n") + 1) / 2)
    high = F.floor(F.col("total_n") / 2) + 1

    def holds(rank):
        return (rank > F.col("cum_n") - F.col("n")) & (rank <= F.col("cum_n"))

    return ranks.groupBy("column").agg(
        (
            F.max(F.when(holds(low), F.col("value"))) / 2 + F.max(F.when(holds(high), F.col("value"))) / 2
        ).alias("median")
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all text columns in one pass; missing values are left out."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )


def most_frequent(counts: DataFrame) -> dict[str, str]:
    """Most frequent value per column of ``category_counts``, the smallest among equals."""
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per text column, None for a column without values."""
    found = most_frequent(category_counts(df, columns)) if columns else {}
    return {c: found.get(c) for c in columns}


def moments(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation after filling missing values; a zero deviation is 1."""
    if not fills:
        return {}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(fill)) for c, fill in fills.items()}
    row = df.agg(
        *[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in fills}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(class, weight): balanced weights n / (classes * rows of the class), a small table however many rows there are."""
    counts = class_counts(df, label)
    total, classes = counts.agg(F.sum("n"), F.count("*")).first()
    return counts.select("class", (F.lit(total or 0) / (F.lit(float(classes)) * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label: str, weights: DataFrame, name: str = "weight") -> DataFrame:
    """Add the weight of the row's class, NULL for a class without one."""
    named = weights.select(F.col("class").alias("_class"), F.col("weight").alias("_weight"))
    joined = df.join(named, F.col(label).eqNullSafe(F.col("_class")), "left")
    return joined.select(*df.columns, F.col("_weight").alias(name))
