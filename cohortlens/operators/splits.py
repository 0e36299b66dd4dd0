"""The exact best split of a numeric target, over all features and all thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ranking import running_totals


def best_split(df: DataFrame, target: str, x: str = "x") -> DataFrame:
    """(feature, threshold, left_value, right_value, gain), one row; none if no feature has two values.

    ``x`` is an array of doubles, features are its positions. Every midpoint between neighbouring values
    of a feature is tried; a split's gain is what it takes off the sum of squared errors of ``target``,
    and the side values are its means. Ties go to the smaller feature, then to the smaller threshold.
    Rows are counted per distinct value first, so what is ordered are values, in slices of bounded size.
    """
    long = df.select(F.posexplode(x).alias("feature", "value"), F.col(target).cast("double").alias("y"))
    counted = long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("y").alias("y"))
    totals = running_totals(counted, "value", ["n", "y"], within=["feature"])
    rest_n, rest_y = F.col("total_n") - F.col("cum_n"), F.col("total_y") - F.col("cum_y")
    gain = F.pow("cum_y", F.lit(2)) / F.col("cum_n") + F.pow(rest_y, F.lit(2)) / rest_n - F.pow("total_y", F.lit(2)) / F.col("total_n")
    tried = totals.where("cum_n < total_n").withColumns(
        {"gain": gain, "left_value": F.col("cum_y") / F.col("cum_n"), "right_value": rest_y / rest_n}
    )
    best = tried.orderBy(F.desc("gain"), "feature", "value").limit(1)
    above = best.select("feature", F.col("value").alias("low")).join(counted, "feature").where("value > low")
    threshold = above.groupBy("feature", "low").agg(((F.col("low") + F.min("value")) / 2).alias("threshold"))
    return best.join(threshold.drop("low"), "feature").select("feature", "threshold", "left_value", "right_value", "gain")
