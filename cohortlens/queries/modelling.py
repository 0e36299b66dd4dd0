"""Models and attributions on the embedding vectors.

Fits use the operators' own settings. What a fit returns has no SQL counterpart; the queries that can be
checked return an identity of the method, or apply the method to coefficients that SQL knows too.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import half_up
from ..operators import models
from ..operators.attribution import (
    attribution_long, background_means, beeswarm, importance, linear_contributions, linear_terms, sampled_contributions,
)
from ..operators.ranking import top_ranked
from ..operators.sampling import fixed_sample, stratified_split
from ..operators.splits import best_split
from ..operators.stats import class_weights, with_weights
from ..operators.tree_shap import node_table, tree_contributions, tree_scores
from ..session import materialize
from ..specs import BACKGROUND_ROWS, BEESWARM_FEATURES, TOP_FEATURES
from . import sql
from .tables import table

WIDTH = 64
NAMES = [f"e{j}" for j in range(WIDTH)]
# The vectors have ten classes; the upper half is the positive one.
POSITIVE_FROM = 5


def vectors(spark: SparkSession, d: str) -> DataFrame:
    label = (F.col("label") >= POSITIVE_FROM).cast("int")
    features = array_to_vector(F.col("embedding").cast("array<double>"))
    return table(spark, d, "embeddings").select("vec_id", features.alias("features"), label.alias("label"))


def weighted(rows: DataFrame) -> DataFrame:
    return with_weights(rows, "label", class_weights(rows, "label"), models.WEIGHT)


def total_weight(rows: DataFrame) -> float:
    return rows.agg(F.sum(models.WEIGHT)).first()[0]


def fit_logistic(spark: SparkSession, d: str):
    rows = weighted(vectors(spark, d))
    return models.logistic_regression(total_weight(rows)).fit(rows), rows


def fit_forest(spark: SparkSession, d: str):
    rows = weighted(vectors(spark, d))
    return models.random_forest().fit(rows), rows


def fit_boosting(spark: SparkSession, d: str):
    rows = vectors(spark, d)
    return models.gradient_boosting().fit(rows), rows


def q23_linear_shap(spark: SparkSession, d: str) -> DataFrame:
    """Linear attributions for fixed coefficients, in long form."""
    return attribution_long(linear_rows(spark, d), NAMES, ["vec_id"]).select(
        "vec_id", "feature", half_up(F.col("phi"), 7).alias("phi")
    )


def linear_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = vectors(spark, d).select("vec_id", vector_to_array("features").alias("x"))
    background = fixed_sample(rows, BACKGROUND_ROWS, "vec_id", order=F.expr(sql.number("vec_id")))
    slopes = [(j % 7 - 3) * 0.25 for j in range(WIDTH)]
    return rows.withColumn("phi", linear_terms(F.col("x"), slopes, background_means(background)))


LINEAR = f"""SELECT u.vec_id, u.j, (x - mean) * ((u.j % 7 - 3) * 0.25) AS phi FROM u JOIN m USING (j)"""


UNNESTED = f"""WITH u AS (SELECT vec_id, unnest(range({WIDTH})) AS j, CAST(unnest(embedding) AS double) AS x FROM embeddings),
b AS (SELECT vec_id FROM embeddings ORDER BY {sql.number('vec_id')}, vec_id LIMIT {BACKGROUND_ROWS}),
m AS (SELECT j, avg(x) AS mean FROM u JOIN b USING (vec_id) GROUP BY j)"""


Q23 = f"{UNNESTED} SELECT vec_id, 'e' || j AS feature, {sql.rounded('phi', 7)} AS phi FROM ({LINEAR})"


def q24_topk(spark: SparkSession, d: str) -> DataFrame:
    ranked = top_ranked(importance(linear_rows(spark, d), NAMES), "mean_abs_shap", "feature", TOP_FEATURES)
    return ranked.withColumn("mean_abs_shap", half_up(F.col("mean_abs_shap"), 7))


Q24 = f"""{UNNESTED}, i AS (SELECT 'e' || j AS feature, avg(abs(phi)) AS v FROM ({LINEAR}) GROUP BY j)
SELECT CAST(row_number() OVER (ORDER BY v DESC, feature) AS integer) AS rank, feature, {sql.rounded('v', 7)} AS mean_abs_shap
FROM i ORDER BY v DESC, feature LIMIT {TOP_FEATURES}"""


def q27_model_table(spark: SparkSession, d: str) -> DataFrame:
    """All three models trained and measured by the training loop: for each the test rows and positives, which SQL
    knows from the split's rule, and how far its accuracy is from a plain count over its stored scores."""
    features = [F.col("embedding")[j].cast("double").alias(c) for j, c in enumerate(NAMES)]
    label = (F.col("label") >= POSITIVE_FROM).cast("int").alias("label")
    frame = table(spark, d, "embeddings").select("vec_id", label, *features)
    split = materialize(stratified_split(frame, "label", "vec_id"))
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    trained = models.train_and_evaluate(train, test, NAMES, [], "label", "vec_id")
    counted = models.all_scores(trained.scored).groupBy("model").agg(
        F.count("*").alias("n_test"), F.sum("label").alias("n_positive"), F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("right")
    )
    gap = F.abs(half_up(F.col("right") - F.col("accuracy"), 9)).alias("accuracy_gap")
    ranked = F.col("roc_auc").between(0, 1).alias("auc_in_range")
    return counted.join(trained.performance, "model").select("model", "n_test", "n_positive", gap, ranked)


Q27 = f"""WITH c AS (SELECT label >= {POSITIVE_FROM} AS y, count(*) AS k, CAST(sum(count(*)) OVER () AS bigint) AS n FROM embeddings GROUP BY 1),
f AS (SELECT *, n - CAST(ceil(n / 5.0) AS bigint) AS n_train FROM c),
g AS (SELECT *, n_train * k // n AS low, n_train * k % n AS rest FROM f),
z AS (SELECT y, k - low - CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= n_train - sum(low) OVER () THEN 1 ELSE 0 END AS n_test FROM g)
SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS model, CAST(sum(n_test) AS bigint) AS n_test,
  CAST(sum(n_test) FILTER (y) AS bigint) AS n_positive, CAST(0.0 AS double) AS accuracy_gap, true AS auc_in_range FROM z"""


def q23b_fitted_linear_shap(spark: SparkSession, d: str) -> DataFrame:
    """Linear attributions of a fitted model whose coefficient SQL finds too: with one yes-or-no feature and
    next to no penalty it is the logarithm of the odds ratio."""
    rows = vectors(spark, d).withColumn("features", array_to_vector(F.array((vector_to_array("features")[0] > 0).cast("double"))))
    rows = weighted(rows)
    model = models.logistic_regression(total_weight(rows), inverse_penalty=1e12).setTol(1e-13).fit(rows)
    explained, _ = linear_contributions(rows, model, ["vec_id"], rows)
    return explained.select("vec_id", half_up(F.col("phi")[0], 5).alias("phi"))


Q23B = f"""WITH r AS (SELECT vec_id, CAST(embedding[1] > 0 AS integer) AS x, label >= {POSITIVE_FROM} AS y FROM embeddings),
o AS (SELECT x, CAST(count(*) FILTER (y) AS double) / count(*) FILTER (NOT y) AS odds FROM r GROUP BY x),
s AS (SELECT ln(max(odds) FILTER (x = 1) / max(odds) FILTER (x = 0)) AS slope FROM o),
m AS (SELECT avg(x) AS mean FROM r)
SELECT vec_id, {sql.rounded('slope * (x - mean)', 5)} AS phi FROM r, s, m"""


def _scored_alike(rows: DataFrame, own: Column) -> DataFrame:
    """Per row how far the model's score and class are from those computed here."""
    right = (F.col("prediction") == (own > 0.5).cast("double")) | (F.abs(own - 0.5) < 1e-9)
    return rows.select("vec_id", "label", F.abs(half_up(F.col("score") - own, 9)).alias("gap"), right.alias("class_agrees"))


SCORED_ALIKE = f"SELECT vec_id, CAST(label >= {POSITIVE_FROM} AS integer) AS label, CAST(0.0 AS double) AS gap, true AS class_agrees FROM embeddings"


def q30_logreg(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the fitted model against the logistic function of its coefficients."""
    model, rows = fit_logistic(spark, d)
    terms = F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(c)) for c in model.coefficients]), lambda x, c: x * c)
    margin = F.aggregate(terms, F.lit(float(model.intercept)), lambda a, t: a + t)
    return _scored_alike(models.score(model, rows), 1 / (1 + F.exp(-margin)))


def q30b_logreg_balance(spark: SparkSession, d: str) -> DataFrame:
    """At the optimum the unpenalised intercept makes weighted scores and labels sum to the same."""
    model, rows = fit_logistic(spark, d)
    gap = F.sum(F.col(models.WEIGHT) * (F.col("score") - F.col("label"))) / F.count("*")
    return models.score(model, rows).agg(F.abs(half_up(gap, 4)).alias("gap"), F.count("*").alias("n"))


Q30B = "SELECT CAST(0.0 AS double) AS gap, count(*) AS n FROM embeddings"


def q30c_logreg_gradient(spark: SparkSession, d: str) -> DataFrame:
    """The gradient of the penalised loss at each fitted coefficient, relative to the total weight: next to
    nothing, and only so for the right penalty."""
    model, rows = fit_logistic(spark, d)
    total = total_weight(rows)
    slopes = F.array(*[F.lit(float(c)) for c in model.coefficients])
    scored = models.score(model, rows).withColumn("gap", F.col(models.WEIGHT) * (F.col("score") - F.col("label")))
    sums = scored.select("gap", F.posexplode(vector_to_array("features")).alias("j", "x"))
    sums = sums.groupBy("j").agg((F.sum(F.col("gap") * F.col("x")) / total).alias("g"))
    gradient = F.col("g") + F.lit(1.0 / total) * F.get(slopes, F.col("j"))
    return sums.select(F.concat(F.lit("e"), F.col("j")).alias("feature"), F.abs(half_up(gradient, 4)).alias("gradient"))


Q30C = f"SELECT 'e' || j AS feature, CAST(0.0 AS double) AS gradient FROM range({WIDTH}) t(j)"


def q31_forest(spark: SparkSession, d: str) -> DataFrame:
    """The forest's probabilities against walks down the trees of its node table."""
    model, rows = fit_forest(spark, d)
    walked = tree_scores(models.score(model, rows), model, ["vec_id", "label", "prediction", "score"])
    return _scored_alike(walked, F.col("total"))


def q32_gbt(spark: SparkSession, d: str) -> DataFrame:
    """The boosted probabilities against walks down the trees, whose values add up to the log-odds."""
    model, rows = fit_boosting(spark, d)
    walked = tree_scores(models.score(model, rows), model, ["vec_id", "label", "prediction", "score"])
    return _scored_alike(walked, 1 / (1 + F.exp(-F.col("total"))))


def q32b_one_split(spark: SparkSession, d: str) -> DataFrame:
    """A single boosted tree of one split, fitted on every threshold, and the split found by exact search."""
    rows = vectors(spark, d).withColumn("sign", 2.0 * F.col("label") - 1.0)
    booster = models.gradient_boosting(1, 1).setSubsamplingRate(1.0).setMaxBins(rows.count() + 1)
    nodes = node_table(spark, booster.fit(rows))
    root, left, right = (nodes.where(F.col("id") == k) for k in range(3))
    # Values in the node table are log-odds, twice the mean of the signs.
    fitted = root.select(F.lit("fitted").alias("source"), "feature", "threshold").crossJoin(
        left.select((F.col("value") / 2).alias("left_value"))
    ).crossJoin(right.select((F.col("value") / 2).alias("right_value")))
    found = best_split(rows.select("sign", vector_to_array("features").alias("x")), "sign")
    both = fitted.unionByName(found.drop("gain").withColumn("source", F.lit("searched")))
    return both.select("source", F.concat(F.lit("e"), "feature").alias("feature"), *[half_up(F.col(c), 7).alias(c) for c in ("threshold", "left_value", "right_value")])


Q32B = f"""WITH u AS (SELECT unnest(range({WIDTH})) AS j, CAST(unnest(embedding) AS double) AS x,
  CASE WHEN label >= {POSITIVE_FROM} THEN 1.0 ELSE -1.0 END::DOUBLE AS y FROM embeddings),
c AS (SELECT j, x, count(*) AS n, sum(y) AS y FROM u GROUP BY j, x),
r AS (SELECT j, x, lead(x) OVER w AS above, sum(n) OVER w AS ln, sum(y) OVER w AS ly,
  sum(n) OVER (PARTITION BY j) AS tn, sum(y) OVER (PARTITION BY j) AS ty FROM c WINDOW w AS (PARTITION BY j ORDER BY x)),
b AS (SELECT * FROM r WHERE above IS NOT NULL ORDER BY ly * ly / ln + (ty - ly) * (ty - ly) / (tn - ln) DESC, j, x LIMIT 1)
SELECT unnest(['fitted', 'searched']) AS source, 'e' || j AS feature, {sql.rounded('(x + above) / 2', 7)} AS threshold,
  {sql.rounded('ly / ln', 7)} AS left_value, {sql.rounded('(ty - ly) / (tn - ln)', 7)} AS right_value FROM b"""


def q33_tree_shap(spark: SparkSession, d: str) -> DataFrame:
    model, rows = fit_forest(spark, d)
    return attribution_long(tree_contributions(rows, model, ["vec_id"])[0], NAMES, ["vec_id"])


def _added_up(explained: DataFrame, base: float):
    return F.aggregate("phi", F.lit(base), lambda a, x: a + x)


def q33b_forest_shap_adds_up(spark: SparkSession, d: str) -> DataFrame:
    """Base value plus attributions minus the forest's probability, per row."""
    model, rows = fit_forest(spark, d)
    explained, base = tree_contributions(models.score(model, rows), model, ["vec_id", "score"])
    return explained.select("vec_id", F.abs(half_up(_added_up(explained, base) - F.col("score"), 9)).alias("gap"))


def q33c_boosting_shap_adds_up(spark: SparkSession, d: str) -> DataFrame:
    """Base value plus attributions minus the boosted log-odds, per row."""
    model, rows = fit_boosting(spark, d)
    explained, base = tree_contributions(models.score(model, rows), model, ["vec_id", "score"])
    margin = F.log(F.col("score") / (1 - F.col("score")))
    return explained.select("vec_id", F.abs(half_up(_added_up(explained, base) - margin, 9)).alias("gap"))


# A small tree of three features: (node, left, right, feature, threshold, first leaf, last leaf); leaves are 7 to 14.
# One path tests a feature twice.
SMALL_TREE = (
    (0, 1, 2, 0, 0.0, 7, 14), (1, 3, 4, 1, 0.0, 7, 10), (2, 5, 6, 1, 0.05, 11, 14), (3, 7, 8, 0, -0.1, 7, 8),
    (4, 9, 10, 2, 0.0, 9, 10), (5, 11, 12, 2, 0.02, 11, 12), (6, 13, 14, 2, -0.03, 13, 14),
)


def _small_leaf(x) -> str:
    """SQL for the leaf that a row reaches; ``x`` gives the SQL of a feature."""

    def below(node: int) -> str:
        if node > 6:
            return str(node)
        _, left, right, feature, threshold, _, _ = SMALL_TREE[node]
        return f"CASE WHEN {x(feature)} <= {threshold} THEN {below(left)} ELSE {below(right)} END"

    return below(0)


def q33d_tree_coalitions(spark: SparkSession, d: str) -> DataFrame:
    """Attributions of a small tree, whose covers and leaf values come from all rows, against all coalitions in SQL."""
    rows = vectors(spark, d).withColumn("x", vector_to_array("features"))
    leaves = rows.select(F.expr(_small_leaf(lambda j: f"x[{j}]")).alias("leaf"), "label")
    counts = leaves.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("label").alias("k"))
    shape = [*SMALL_TREE, *((leaf, -1, -1, -1, None, leaf, leaf) for leaf in range(7, 15))]
    tree = spark.createDataFrame(shape, "id int, left int, right int, feature int, threshold double, low int, high int")
    # One row is added to every leaf, so that none is empty.
    spread_out = F.col("high") - F.col("low") + 1
    nodes = tree.join(counts, F.col("leaf").between(F.col("low"), F.col("high")), "left").groupBy(tree.columns).agg(
        (F.coalesce(F.sum("n"), F.lit(0)) + spread_out).cast("double").alias("cover"),
        (F.coalesce(F.sum("k"), F.lit(0)) / (F.coalesce(F.sum("n"), F.lit(0)) + spread_out)).alias("value"),
    )
    nodes = nodes.select(F.lit(0).alias("tree"), "id", "left", "right", "feature", "threshold", "cover", "value")
    explained, _ = tree_contributions(rows, nodes, ["vec_id"])
    return attribution_long(explained, NAMES, ["vec_id"]).where(F.col("feature").isin(NAMES[:3])).select(
        "vec_id", "feature", half_up(F.col("phi"), 7).alias("phi")
    )


def _coalitions_sql() -> str:
    """The values of all eight coalitions, each the sum over leaves of value times met conditions or shares."""
    paths = {}

    def unfold(node: int, met: dict) -> None:
        if node > 6:
            paths[node] = met
            return
        _, left, right, j, threshold, _, _ = SMALL_TREE[node]
        for child, sign in ((left, "<="), (right, ">")):
            conditions, shares = met.get(j, ((), ()))
            unfold(child, met | {j: ((*conditions, f"x{j} {sign} {threshold}"), (*shares, f"c{child} / c{node}"))})

    unfold(0, {})
    covers = {leaf: f"(sum(CASE WHEN leaf = {leaf} THEN 1 ELSE 0 END) + 1)" for leaf in range(7, 15)}
    covers |= {k: " + ".join(covers[leaf] for leaf in range(low, high + 1)) for k, *_, low, high in SMALL_TREE}
    values = {leaf: f"sum(CASE WHEN leaf = {leaf} THEN label ELSE 0 END) / CAST({covers[leaf]} AS double)" for leaf in range(7, 15)}

    def worth(known: int) -> str:
        return " + ".join(
            " * ".join([f"v{leaf}"] + [
                f"CAST({' AND '.join(conditions)} AS integer)" if known >> j & 1 else " * ".join(shares)
                for j, (conditions, shares) in met.items()
            ])
            for leaf, met in paths.items()
        )

    weight = {0: "1 / 3.0", 1: "1 / 6.0", 2: "1 / 3.0"}  # s! (2 - s)! / 3!
    phi = {
        j: " + ".join(f"{weight[k.bit_count()]} * (w{k | 1 << j} - w{k})" for k in range(8) if not k >> j & 1) for j in range(3)
    }
    columns = ", ".join(f"CAST(embedding[{j + 1}] AS double) AS x{j}" for j in range(3))
    union = " UNION ALL ".join(f"SELECT vec_id, 'e{j}' AS feature, {sql.rounded(f'CAST({phi[j]} AS double)', 7)} AS phi FROM w" for j in range(3))
    return f"""WITH r AS (SELECT vec_id, CAST(label >= {POSITIVE_FROM} AS integer) AS label, {columns} FROM embeddings),
l AS (SELECT *, {_small_leaf(lambda j: f'x{j}')} AS leaf FROM r),
t AS (SELECT {', '.join(f'CAST({c} AS double) AS c{k}' for k, c in covers.items())}, {', '.join(f'{v} AS v{k}' for k, v in values.items())} FROM l),
w AS (SELECT vec_id, {', '.join(f'{worth(k)} AS w{k}' for k in range(8))} FROM l CROSS JOIN t)
{union}"""


ADDS_UP = "SELECT vec_id, CAST(0.0 AS double) AS gap FROM embeddings"


def q34_sampled_shap(spark: SparkSession, d: str) -> DataFrame:
    """Model-agnostic attributions."""
    model, rows = fit_logistic(spark, d)
    background = fixed_sample(rows, BACKGROUND_ROWS, "vec_id")
    explained, _ = sampled_contributions(rows, model, "vec_id", background)
    return attribution_long(explained, NAMES, ["vec_id"])


def q34b_sampled_shap_of_sums(spark: SparkSession, d: str) -> DataFrame:
    """Sampled attributions of a fixed linear score, which come out the same in any feature order."""
    rows = vectors(spark, d)
    background = fixed_sample(rows, BACKGROUND_ROWS, "vec_id", order=F.expr(sql.number("vec_id")))
    slopes = np.array([(j % 7 - 3) * 0.25 for j in range(WIDTH)])
    explained, _ = sampled_contributions(rows, None, "vec_id", background, arrays=lambda x: x @ slopes)
    return attribution_long(explained, NAMES, ["vec_id"]).select("vec_id", "feature", half_up(F.col("phi"), 7).alias("phi"))


def q35_attribution_long(spark: SparkSession, d: str) -> DataFrame:
    """The table behind a summary plot: the most important features of the fixed linear attributions."""
    long = beeswarm(materialize(linear_rows(spark, d)), NAMES, "vec_id", BEESWARM_FEATURES)
    return long.select("vec_id", "feature", "value", *[half_up(F.col(c), 7).alias(c) for c in ("phi", "mean_abs_shap")])


Q35 = f"""{UNNESTED}, l AS ({LINEAR}),
top AS (SELECT j, avg(abs(phi)) AS v FROM l GROUP BY j ORDER BY v DESC, 'e' || j LIMIT {BEESWARM_FEATURES})
SELECT l.vec_id, 'e' || l.j AS feature, u.x AS value, {sql.rounded('phi', 7)} AS phi, {sql.rounded('v', 7)} AS mean_abs_shap
FROM l JOIN u ON l.vec_id = u.vec_id AND l.j = u.j JOIN top ON l.j = top.j"""


QUERIES = {
    "q23_linear_shap": q23_linear_shap,
    "q23b_fitted_linear_shap": q23b_fitted_linear_shap,
    "q24_topk": q24_topk,
    "q27_model_table": q27_model_table,
    "q30_logreg": q30_logreg,
    "q30b_logreg_balance": q30b_logreg_balance,
    "q30c_logreg_gradient": q30c_logreg_gradient,
    "q31_forest": q31_forest,
    "q32_gbt": q32_gbt,
    "q32b_one_split": q32b_one_split,
    "q33_tree_shap": q33_tree_shap,
    "q33b_forest_shap_adds_up": q33b_forest_shap_adds_up,
    "q33c_boosting_shap_adds_up": q33c_boosting_shap_adds_up,
    "q33d_tree_coalitions": q33d_tree_coalitions,
    "q34_sampled_shap": q34_sampled_shap,
    "q34b_sampled_shap_of_sums": q34b_sampled_shap_of_sums,
    "q35_attribution_long": q35_attribution_long,
}
ORACLES = {
    "q23_linear_shap": Q23,
    "q23b_fitted_linear_shap": Q23B,
    "q24_topk": Q24,
    "q27_model_table": Q27,
    "q30_logreg": SCORED_ALIKE,
    "q30b_logreg_balance": Q30B,
    "q30c_logreg_gradient": Q30C,
    "q31_forest": SCORED_ALIKE,
    "q32_gbt": SCORED_ALIKE,
    "q32b_one_split": Q32B,
    "q33b_forest_shap_adds_up": ADDS_UP,
    "q33c_boosting_shap_adds_up": ADDS_UP,
    "q33d_tree_coalitions": _coalitions_sql(),
    "q34b_sampled_shap_of_sums": Q23,
    "q35_attribution_long": Q35,
}
