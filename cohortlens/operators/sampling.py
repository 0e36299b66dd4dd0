"""Exact-size sampling and splitting, independent of partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import seeded_hash
from ..session import materialize
from ..specs import SEED, TEST_FRACTION
from .ranking import running_totals

NUMBER_SHIFTS = (20, 10, 0)  # bits below a counting block: 4096 blocks, then 1024 in one, then single numbers
PLACE_SHIFTS = (50, 37, 24, 12, 0)  # the same for places in a table, numbers below 2**63


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(class, n) for every value of ``label``, NULL being one, stored: a class for each row is no problem."""
    return materialize(df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n")))


def split_sizes(counts: DataFrame, fraction: float) -> DataFrame:
    """(class, n_test): ceil(fraction * n) test rows in total, shared out by largest remainder, which is
    given to training rows; equal remainders go to the classes that are first as text."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_train = total - math.ceil(round(fraction * total, 9))
    share, whole = f"CAST(n AS decimal(19,0)) * {n_train}BD", f"{max(1, total)}BD"
    shared = counts.select("class", "n", F.expr(f"{share} div {whole}").alias("low"), F.expr(f"({share}) % {whole}").alias("rest"))
    extra = n_train - shared.agg(F.coalesce(F.sum("low"), F.lit(0))).first()[0]
    placed = F.struct((-F.col("rest")).alias("a"), F.coalesce(F.col("class").cast("string"), F.lit("None")).alias("b"))
    ranked = running_totals(shared.select("class", "n", "low", placed.alias("place"), F.lit(1).alias("one")), "place", ["one"])
    return ranked.select("class", (F.col("n") - F.col("low") - (F.col("cum_one") <= extra).cast("long")).alias("n_test"))


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    order: Column | None = None,
) -> DataFrame:
    """Add a ``split`` column ('test' / 'train') with exact test sizes per class.

    A row is a test row if its pseudo-random number (``order``, an integer in [0, 2**32)) is among
    the smallest of its class, ties by ``row_id`` and then by the row's place in the table, which is
    written out once: rows that share an identifier, or have none, are told apart. Instead of ranking
    whole classes, the cut-off row of each class is located by counting ever smaller blocks of numbers.
    Classes, sizes and cut-offs are tables, however many there are; rows meet them by a join on the
    class, which AQE splits where a class is large, or broadcasts where the classes are few.
    """
    number = seeded_hash(seed, row_id) if order is None else order
    stored = materialize(df.withColumns({"_number": number.cast("long"), "_tie": F.monotonically_increasing_id()}))
    wanted = split_sizes(class_counts(stored, label), fraction).where("n_test > 0").select("class", F.col("n_test").alias("left"))
    keyed = stored.select(F.col(label).alias("class"), "_number", F.col(row_id).alias("_id"), "_tie")
    numbers = materialize(_cut_numbers(keyed, "_number", wanted, NUMBER_SHIFTS))
    if numbers.where("left < n").isEmpty():  # no class has to divide the rows of its last number
        cuts = numbers.select(F.col("class").alias("_class"), F.struct(F.col("cut").alias("_number")).alias("_cut"))
        at = F.struct("_number")
    else:
        cuts = materialize(_cut_rows(keyed, numbers))
        cuts = cuts.select(F.col("class").alias("_class"), F.struct("_number", "_id", "_tie").alias("_cut"))
        at = F.struct(F.col("_number"), F.col(row_id).alias("_id"), F.col("_tie"))
    joined = stored.join(cuts, F.col(label).eqNullSafe(F.col("_class")), "left")
    split = F.when(F.coalesce(at <= F.col("_cut"), F.lit(False)), "test").otherwise("train")
    return joined.select(*df.columns, split.alias("split"))


def grouped_split(
    df: DataFrame, label: str, group: str, fraction: float = TEST_FRACTION, seed: int = SEED, order: Column | None = None
) -> DataFrame:
    """Add ``split`` so that no group is on both sides: groups are split, stratified by their largest
    label, and rows follow. Test sizes are exact in groups. Rows without a group are training rows.

    Only the groups of the smaller side, the test side, meet the rows; they are stored, so that their size decides
    whether the rows have to be shuffled for them."""
    number = seeded_hash(seed, group) if order is None else order
    groups = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(label).alias(label))
    tested = stratified_split(groups, label, group, fraction, seed, number).where("split = 'test'")
    return df.join(materialize(tested.select(group, "split")), group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def _cut_rows(keyed: DataFrame, numbers: DataFrame) -> DataFrame:
    """The last wanted row of each class: class, _number, _id, _tie. ``numbers`` has its number (``cut``) and how
    many rows of that number are wanted (``left``).

    Such rows are few unless they share an identifier. Among them the identifier is found by running totals,
    and the row by its place in the table.
    """
    same = keyed.join(numbers.select(F.col("class").alias("_of"), F.col("cut"), "left"), F.col("class").eqNullSafe(F.col("_of")))
    same = materialize(same.where("_number = cut").select("class", "_number", "_id", "_tie", "left"))
    counted = same.groupBy("class", "_id").agg(F.count("*").alias("n"), F.first("left").alias("left"))
    totals = running_totals(counted, "_id", ["n"], within=["class"])
    ids = totals.where("left > cum_n - n AND left <= cum_n").select(
        F.struct("class", F.col("_id").alias("id")).alias("class"), (F.col("left") - F.col("cum_n") + F.col("n")).alias("left")
    )
    places = same.select(F.struct("class", F.col("_id").alias("id")).alias("class"), "_tie", "_number")
    found = _cut_numbers(places, "_tie", materialize(ids), PLACE_SHIFTS)
    ends = found.select("class.class", F.col("class.id").alias("_id"), F.col("cut").alias("_tie"))
    numbers = numbers.select(F.col("class").alias("_of"), F.col("cut").alias("_number"))
    return ends.join(numbers, F.col("class").eqNullSafe(F.col("_of"))).select("class", "_number", "_id", "_tie")


def _cut_numbers(keyed: DataFrame, number: str, wanted: DataFrame, shifts: Sequence[int]) -> DataFrame:
    """(class, cut, left, n): the number of the last wanted row of each class, and how many of its n rows are wanted.

    Rows are counted in blocks of numbers; the block with the cut is counted in smaller ones, down to
    single numbers. A class has some thousand blocks at most.
    """
    cut, above = wanted.select(F.col("class").alias("_of"), F.lit(0).cast("long").alias("_in"), "left"), 63
    for shift in shifts:
        block = F.shiftright(F.col(number), shift)
        here = F.lit(0).cast("long") if above == 63 else F.shiftright(F.col(number), above)
        inside = keyed.select("class", here.alias("_here"), block.alias("_block")).groupBy("class", "_here", "_block").agg(F.count("*").alias("_n"))
        inside = inside.join(cut.select("_of", "_in", "left"), F.col("class").eqNullSafe(F.col("_of")) & (F.col("_here") == F.col("_in")))
        running = Window.partitionBy("class").orderBy("_block")
        inside = inside.withColumn("_cum", F.sum("_n").over(running)).where("left > _cum - _n AND left <= _cum")
        left = F.col("left") - F.col("_cum") + F.col("_n")
        cut = inside.select(F.col("class").alias("_of"), F.col("_block").alias("_in"), left.alias("left"), F.col("_n").alias("_of_it"))
        above = shift
    return cut.select(F.col("_of").alias("class"), F.col("_in").alias("cut"), "left", F.col("_of_it").alias("n"))


def fixed_sample(df: DataFrame, n: int, row_id: str, seed: int = SEED, order: Column | None = None) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), chosen uniformly and reproducibly, n of any size.

    Rows with the smallest numbers are taken, ties by ``row_id``. The last number is found by counting
    blocks of numbers, three passes over one column; rows of smaller numbers then come from a plain
    filter, and only those of the last number, few unless identifiers repeat, are stored and ordered.
    """
    number = (seeded_hash(seed, row_id) if order is None else order).cast("long")
    keyed = df.select(F.lit(0).alias("class"), number.alias("_number"))
    wanted = df.sparkSession.range(1).select(F.lit(0).alias("class"), F.lit(n).cast("long").alias("left"))
    cut = _cut_numbers(keyed, "_number", wanted, NUMBER_SHIFTS).first()
    if cut is None:  # fewer rows than wanted, or none wanted
        return df if n > 0 else df.limit(0)
    if cut["left"] == cut["n"]:
        return df.where(number <= cut["cut"])
    last = materialize(df.where(number == cut["cut"]).withColumns({"_number": number, "_tie": F.monotonically_increasing_id()}))
    at = last.select(F.lit(0).alias("class"), "_number", F.col(row_id).alias("_id"), "_tie")
    numbers = wanted.select("class", F.lit(cut["cut"]).alias("cut"), F.lit(cut["left"]).alias("left"))
    end = _cut_rows(at, numbers).select(F.struct("_id", "_tie").alias("_cut"))
    # One row.
    last = last.join(F.broadcast(end)).where(F.struct(F.col(row_id).alias("_id"), F.col("_tie")) <= F.col("_cut"))
    return df.where(number < cut["cut"]).unionByName(last.select(df.columns))
