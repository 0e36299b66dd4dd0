"""Per-row attributions for any of the models, and their global summaries."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, spread
from ..specs import BACKGROUND_ROWS, SEED
from .meeting import meet
from .models import score
from .ranking import top_k
from .sampling import fixed_sample
from .tree_shap import TREE_MODELS, tree_contributions
from .walks import ArrayScorer, array_scorer, walk

BLOCK_ROWS = 4096  # background rows in a block

# What runs in tasks travels by value; the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feature_stages(pipeline: PipelineModel) -> PipelineModel:
    """What comes before the classifier, as a pipeline of its own."""
    return PipelineModel(stages=pipeline.stages[:-1])


def linear_terms(x: Column, coefficients: Sequence[float], means: Sequence[float]) -> Column:
    """coefficient * (x - background mean) per feature, on an array column."""
    lines = F.array(*[F.struct(F.lit(float(c)).alias("slope"), F.lit(float(m)).alias("centre")) for c, m in zip(coefficients, means)])
    return F.zip_with(x, lines, lambda v, line: (v - line["centre"]) * line["slope"])


def background_means(background: DataFrame, x: str = "x") -> list[float]:
    """Mean of each feature over the background rows, in one pass; none for an empty background."""
    means = background.select(F.posexplode(x).alias("j", "v")).groupBy("j").agg(F.avg("v").alias("mean"))
    return [r["mean"] for r in means.orderBy("j").collect()]


def linear_contributions(
    df: DataFrame, model: LogisticRegressionModel, keep: list[str], background: DataFrame, features: str = "features"
) -> tuple[DataFrame, float]:
    """(``keep``, x, phi) per row on the log-odds scale, and the base value; a plain projection."""
    means = background_means(background.select(vector_to_array(features).alias("x")))
    slopes = model.coefficients.toArray()
    rows = df.select(*keep, vector_to_array(features).alias("x"))
    base = float(model.intercept + sum(c * m for c, m in zip(slopes, means)))
    return rows.withColumn("phi", linear_terms(F.col("x"), slopes, means)), base


def sampled_contributions(
    df: DataFrame,
    model: Model,
    row_id: str,
    background: DataFrame,
    permutations: int = 10,
    features: str = "features",
    seed: int = SEED,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
    arrays: ArrayScorer | None = None,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, float]:
    """(row_id, ``keep``, x, phi) for any model with a probability, by permutation sampling, and the base value.

    A walk pairs a row with a background row and a feature order. Along the order, features switch one
    by one from the background's to the row's value; each switch's change of the score belongs to that
    feature. Every row meets every background row equally often, and at least ``permutations`` walks
    are made: the work is rows x background x (features + 1) scores, so choose the background's size.

    The sum of a row's values is its score minus the base value, the mean score of the background.
    Copies of a row, also under one ``row_id`` or a null one, each get the row's own values. ``scorer``
    adds ``score`` to a table with ``features``, ``arrays`` scores a matrix of rows, if it is not the
    model's probability. Where scores can be had from arrays, which holds for the models that
    ``walks.array_scorer`` knows, rows walk inside tasks; else Spark scores a table of mixed vectors.
    """
    arrays = arrays or (array_scorer(model) if scorer is None else None)
    if arrays is not None:
        return _walked(df, row_id, background, permutations, features, seed, arrays, keep)
    scorer = scorer or (lambda mixed: score(model, mixed))
    return _scored_by_spark(df, row_id, background, permutations, features, seed, scorer, keep)


def _walked(
    df: DataFrame, row_id: str, background: DataFrame, permutations: int, features: str, seed: int, arrays: ArrayScorer,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, float]:
    """Blocks of the background meet the rows by key; what the blocks add is summed."""
    stored = materialize(background.select(F.col(row_id).alias("_id"), vector_to_array(features).alias("x")))
    count = stored.count()
    if not count:
        raise ValueError("sampled attributions need a background")
    blocks = F.pmod(F.xxhash64("_id", "x"), F.lit(-(-count // BLOCK_ROWS))).alias("part")

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        x = np.array(block["x"].tolist(), dtype=float)
        x = x[np.lexsort(x.T[::-1])] if x.size else x
        return pd.DataFrame([{"part": block["part"].iloc[0], "packed": pickle.dumps(x), "score": arrays(x).sum()}])

    packed = materialize(stored.select(blocks, "_id", "x").groupBy("part").applyInPandas(pack, "part long, packed binary, score double"))
    base = packed.agg(F.sum("score")).first()[0] / count
    rounds = -(-permutations // count)
    rows = df.select(F.col(row_id), *keep, vector_to_array(features).alias("x"), F.xxhash64(F.col(row_id), F.lit(seed)).alias("_seed"))

    def work(others: np.ndarray, x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return walk(arrays, others, x, seeds, rounds, rounds * count)

    return meet(rows, packed, lambda some: np.vstack([pickle.loads(b) for b in some]), work, "phi"), base


def _scored_by_spark(
    df: DataFrame, row_id: str, background: DataFrame, permutations: int, features: str, seed: int,
    scorer: Callable[[DataFrame], DataFrame], keep: Sequence[str] = (),
) -> tuple[DataFrame, float]:
    """All mixed vectors are scored in one pass; each adds its score to the feature switched last and takes it
    from the feature switched next, so the walk needs neither ordering nor a window, and the sums are
    combined before the shuffle."""
    partners = _numbered_background(background, row_id, features)
    count, size = partners.agg(F.count("*"), F.max(F.size("_other"))).first()
    if not count:
        raise ValueError("sampled attributions need a background")
    base = scorer(partners.withColumn(features, array_to_vector("_other"))).agg(F.avg("score")).first()[0]
    rounds = -(-permutations // count)
    numbered = df.select(F.col(row_id), *keep, vector_to_array(features).alias("x"))
    rows = materialize(spread(numbered).withColumn("_row", F.monotonically_increasing_id()))
    walks = (
        rows.withColumn("_walk", F.explode(F.sequence(F.lit(0), F.lit(rounds * count - 1))))
        .withColumn("_place", F.pmod(F.col("_walk"), F.lit(count)))
        .join(partners, "_place")
        .withColumn("_order", _feature_order(row_id, size, seed))
        .withColumn("_turn", F.array(*[F.array_position("_order", j) for j in range(size)]))
    )
    # _known features have switched so far; feature j does so at turn _turn[j], counted from 1.
    mixed = walks.withColumn("_known", F.explode(F.sequence(F.lit(0), F.lit(size)))).withColumn(
        features, array_to_vector(_mix(size))
    )
    changes = F.filter(
        F.array(
            F.struct(F.get("_order", F.col("_known") - 1).alias("feature"), F.col("score").alias("change")),
            F.struct(F.get("_order", F.col("_known")).alias("feature"), (-F.col("score")).alias("change")),
        ),
        lambda c: c["feature"].isNotNull(),
    )
    summed = (
        scorer(mixed.drop(*keep)).select("_row", F.inline(changes))
        .groupBy("_row", "feature").agg((F.sum("change") / (rounds * count)).alias("value"))
        .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("_phi"))
        .select("_row", F.col("_phi.value").alias("phi"))
    )
    return rows.join(summed, "_row").drop("_row"), base


def _feature_order(row_id: str, size: int, seed: int) -> Column:
    keys = [
        F.struct(F.xxhash64(F.col(row_id), F.col("_walk"), F.lit(j), F.lit(seed)).alias("k"), F.lit(j).alias("j"))
        for j in range(size)
    ]
    return F.transform(F.array_sort(F.array(*keys)), lambda s: s["j"])


def _numbered_background(background: DataFrame, row_id: str, features: str) -> DataFrame:
    """All background vectors, stored, with their place from 0."""
    stored = materialize(background.select(F.col(row_id).alias("_id"), vector_to_array(features).alias("_other")))
    place = F.row_number().over(Window.orderBy("_id", "_other")) - 1
    return materialize(stored.select(place.cast("long").alias("_place"), "_other"))


def _mix(size: int) -> Column:
    return F.array(
        *[F.when(F.col("_turn")[j] <= F.col("_known"), F.col("x")[j]).otherwise(F.col("_other")[j]) for j in range(size)]
    )


def explain(
    df: DataFrame, model: Model, row_id: str, background_rows: int = BACKGROUND_ROWS, features: str = "features",
    background: DataFrame | None = None, keep: Sequence[str] = (),
) -> tuple[DataFrame, float]:
    """(row_id, ``keep``, x, phi) for the positive class by the method that fits the model, and the base value.

    Tree ensembles and linear models are exact, anything else is sampled. ``background`` holds the rows
    to compare with, such as training rows; without it these are a sample of ``df``. Trees carry their own.
    """
    if isinstance(model, TREE_MODELS):
        return tree_contributions(df, model, [row_id, *keep], features)
    if background is None:
        background = materialize(fixed_sample(df, background_rows, row_id))
    if isinstance(model, LogisticRegressionModel):
        return linear_contributions(df, model, [row_id, *keep], background, features)
    return sampled_contributions(df, model, row_id, background, features=features, keep=keep)


def attribution_long(explained: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(``keep``, feature, phi, value): one row per row and feature."""
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("phi"), F.col("x").alias("value"))
    return explained.select(*keep, F.inline(pairs))


def importance(explained: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, mean_abs_shap), most important first."""
    return (
        attribution_long(explained, names, [])
        .groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def beeswarm(explained: DataFrame, names: Sequence[str], row_id: str, k: int) -> DataFrame:
    """The long table of the k most important features, for a summary plot."""
    # At most k rows.
    top = F.broadcast(top_k(importance(explained, names), "mean_abs_shap", "feature", k))
    return attribution_long(explained, names, [row_id]).join(top, "feature")
