"""Global order without a global task: running totals, numbering and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

SLICE_ROWS = 100_000
POSITION_BITS = 33  # of monotonically_increasing_id, which hold a row's position in its partition


def running_totals(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    within: Sequence[str] = (),
    descending: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``cum_<v>`` (sum up to and including the row) and ``total_<v>`` per value column.

    ``df`` must be unique on (within, order), so aggregate ties first; order may be of any sortable type.
    Rows are range-partitioned, and the tasks that sort the ranges cut them into slices of ``slice_rows``
    rows while they write them. Sums run inside a slice; the totals of earlier slices of the range, and of
    earlier ranges, are added to them. So no task sees more than one slice, or one row for each slice of a
    range or for each range, and no list of cuts exists anywhere.
    """
    keys = [*within, order]
    position = F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sliced = materialize(ranged.select("*", F.spark_partition_id().alias("_range"), F.floor(position / slice_rows).alias("_slice")))
    direction = F.desc if descending else F.asc
    by_slice = [*within, "_range", "_slice"]
    slices = sliced.groupBy(*by_slice).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    ranges = slices.groupBy(*within, "_range").agg(*[F.sum(f"_{v}").alias(f"_{v}") for v in values])

    def before(window, place, v):
        rows = window.orderBy(direction(place)).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(f"_{v}").over(rows), F.lit(0))

    whole, inner = Window.partitionBy(*within), Window.partitionBy(*within, "_range")
    ranges = ranges.select(
        *[F.col(c).alias(f"_of_{c}") for c in (*within, "_range")],
        *[before(whole, "_range", v).alias(f"_earlier_{v}") for v in values],
        *[F.sum(f"_{v}").over(whole).alias(f"total_{v}") for v in values],
    )
    slices = slices.select(*[F.col(c).alias(f"_in_{c}") for c in by_slice], *[before(inner, "_slice", v).alias(f"_before_{v}") for v in values])
    inside = Window.partitionBy(*by_slice).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", *[F.sum(v).over(inside).alias(f"_local_{v}") for v in values])
    placed = local.join(slices, _same(by_slice, "_in_")).join(ranges, _same([*within, "_range"], "_of_"))
    return placed.select(
        *df.columns,
        *[(F.col(f"_local_{v}") + F.col(f"_before_{v}") + F.col(f"_earlier_{v}")).alias(f"cum_{v}") for v in values],
        *[f"total_{v}" for v in values],
    )


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Equality of columns with their prefixed counterparts, nulls being equal."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])


def sorted_codes(df: DataFrame, column: str) -> DataFrame:
    """Dictionary (value, code): the distinct non-null values numbered from 0 in sorted order."""
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return number_sorted(values)


def number_sorted(values: DataFrame) -> DataFrame:
    """(value, code) for distinct values: the position inside a range partition plus the sizes before it.

    The partitioned set is written once because range boundaries are sampled anew in every run.
    """
    parts = materialize(
        values.repartitionByRange("value").sortWithinPartitions("value").select(
            "value",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1).alias("_pos"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # One row per range partition.
    numbered = parts.join(F.broadcast(sizes), "_part")
    return numbered.select("value", (F.col("_pos") + F.col("_before")).cast("int").alias("code"))


def top_k(df: DataFrame, by: str, name: str, k: int) -> DataFrame:
    """The k rows with the largest ``by``; ties are settled by name."""
    return df.orderBy(F.desc(by), name).limit(k)


def top_ranked(df: DataFrame, by: str, name: str, k: int) -> DataFrame:
    """``top_k`` with a leading rank column 1..k; the window only sees the k rows."""
    rank = F.row_number().over(Window.orderBy(F.desc(by), name))
    return top_k(df, by, name, k).select(rank.alias("rank"), *df.columns)
