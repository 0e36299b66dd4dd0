"""What the library leaves in files, read back, and the choices it makes for its caller: columns and methods."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import half_up
from ..operators import models
from ..operators.attribution import explain, importance
from ..operators.encode import feature_names, fit_features
from ..operators.metrics import evaluate
from ..operators.sampling import fixed_sample
from ..plans import training
from ..session import scratch, shared_dir
from ..sources import read_csv, write_ranked
from ..specs import BACKGROUND_ROWS, DATASET_COLUMNS, ID_COLUMNS, SUB_LABELS, TARGET, TOP_FEATURES
from . import sql
from .clinical import DATASET, clinical_dataset
from .evaluation import LINES, PERFORMANCE, auc_sql, scored_lines
from .features import Q29, gappy_documents
from .modelling import NAMES, POSITIVE_FROM, Q24, linear_rows, total_weight, vectors, weighted


def q53_ranked_file(spark: SparkSession, d: str) -> DataFrame:
    """The stored ranking of the most important features."""
    path = shared_dir(spark)
    write_ranked(importance(linear_rows(spark, d), NAMES), path, TOP_FEATURES)
    ranked = read_csv(spark, path, "rank int, feature string, mean_abs_shap double")
    return ranked.withColumn("mean_abs_shap", half_up(F.col("mean_abs_shap"), 7))


# Names of models that no file system would like.
TITLES = {"price": "Price > 50,000 (line)", "quantity": " Quantity: 30 + more"}
TITLED = " ".join(f"WHEN '{name}' THEN '{title}'" for name, title in TITLES.items())


def _stored_metrics(spark: SparkSession, d: str) -> str:
    """Where the metrics of two scored models now are."""
    out = shared_dir(spark)
    scored = {TITLES[name]: rows for name, rows in scored_lines(spark, d).items()}
    rows = [evaluate(some, name).withColumn("place", F.lit(i)) for i, (name, some) in enumerate(scored.items())]
    training.store_metrics(rows[0].unionByName(rows[1]), scored, out)
    return out


def q54_metrics_file(spark: SparkSession, d: str) -> DataFrame:
    """The stored metrics table of all models."""
    schema = "model string, accuracy double, precision double, recall double, f1_score double, roc_auc double"
    return read_csv(spark, f"{_stored_metrics(spark, d)}/model_performance", schema)


Q54 = f"""WITH l AS ({LINES}), a AS ({auc_sql('SELECT * FROM l', 'model')})
SELECT CASE model {TITLED} END AS model, accuracy, precision, recall, f1_score, roc_auc FROM ({PERFORMANCE})"""


def q54b_confusion_files(spark: SparkSession, d: str) -> DataFrame:
    """The stored confusion grids, each told by the name of its folder."""
    grids = read_csv(spark, f"{_stored_metrics(spark, d)}/confusion_*", "label int, prediction int, n long")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "confusion_([^/]*)/", 1)
    return grids.select(folder.alias("file"), "label", "prediction", "n")


Q54B = f"""WITH l AS ({LINES}), g AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(y, p) CROSS JOIN (SELECT DISTINCT model FROM l))
SELECT trim(regexp_replace(lower(CASE g.model {TITLED} END), '[^a-z0-9]+', '_', 'g'), '_') AS file,
  y AS label, p AS prediction, count(l.label) AS n
FROM g LEFT JOIN l ON l.model = g.model AND l.label = y AND l.prediction = p GROUP BY g.model, y, p"""


def q55_saved_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature matrix of ``q29`` from a pipeline that was saved and loaded, its dictionaries stored as tables
    of which only those inside the saved pipeline are left."""
    rows, path = gappy_documents(spark, d), shared_dir(spark)
    with scratch(spark):
        fitted = fit_features(rows.where(F.col("toxic").isNotNull()), ["n_chars", "quality"], ["lang", "source"], inline_values=1)
        PipelineModel(stages=fitted.stages).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    matrix = loaded.transform(rows).withColumn("_v", vector_to_array("features"))
    return matrix.select("doc_id", *[half_up(F.col("_v")[i], 6).alias(n) for i, n in enumerate(feature_names(loaded.stages))])


def q56_model_input(spark: SparkSession, d: str) -> DataFrame:
    """The part that each column of the wide table plays in the models, and in how many rows it is filled: the
    target apart from the features, these by type, everything else left out."""
    frame, numeric, categorical = training.prepare(clinical_dataset(spark, d))
    parts = {TARGET: "target"} | dict.fromkeys(numeric, "numeric") | dict.fromkeys(categorical, "categorical")
    filled = frame.agg(*[F.count(c).alias(c) for c in parts])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(part).alias("part"), F.col(c).alias("filled")) for c, part in parts.items()]
    return filled.select(F.inline(F.array(*rows)))


# Text is categorical, but for gender, whose label codes are a number.
Q56 = f"{DATASET} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {"'target'" if c == TARGET else "'numeric'" if c == 'gender' else
    f"CASE WHEN typeof(any_value({c})) = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END"} AS part, count({c}) AS filled FROM dataset"""
    for c in DATASET_COLUMNS if c not in (*ID_COLUMNS, *SUB_LABELS)
)


def q57_explained(spark: SparkSession, d: str) -> DataFrame:
    """Attributions as ``explain`` chooses them for a linear model, a tree and a model of another kind, all fitted
    on one yes-or-no feature, so that SQL knows what each has learned."""
    yes = array_to_vector(F.array((vector_to_array("features")[0] > 0).cast("double")))
    rows = weighted(vectors(spark, d).withColumn("features", yes))
    background = fixed_sample(rows, BACKGROUND_ROWS, "vec_id", order=F.expr(sql.number("vec_id")))
    fitted = {
        "linear": models.logistic_regression(total_weight(rows), inverse_penalty=1e12).setTol(1e-13).fit(rows),
        "tree": models.gradient_boosting(1, 1).setSubsamplingRate(1.0).fit(rows),
        "sampled": NaiveBayes(modelType="bernoulli", smoothing=0.0).fit(rows),
    }
    explained = [
        explain(rows, model, "vec_id", background=background)[0].select(
            F.lit(kind).alias("method"), "vec_id", half_up(F.col("phi")[0], 5).alias("phi")
        )
        for kind, model in fitted.items()
    ]
    return explained[0].unionByName(explained[1]).unionByName(explained[2])


# The slope is the logarithm of the odds ratio, the tree's values are twice the mean signs of its sides, and
# the share of positives is the probability of the third.
Q57 = f"""WITH r AS (SELECT vec_id, CAST(embedding[1] > 0 AS integer) AS x, CAST(label >= {POSITIVE_FROM} AS integer) AS y FROM embeddings),
b AS (SELECT x FROM r ORDER BY {sql.number('vec_id')}, vec_id LIMIT {BACKGROUND_ROWS}),
o AS (SELECT x, avg(y) AS p FROM r GROUP BY x),
s AS (SELECT ln(max(p / (1 - p)) FILTER (x = 1) / max(p / (1 - p)) FILTER (x = 0)) AS slope FROM o),
m AS (SELECT (SELECT avg(x) FROM b) AS mean, (SELECT avg(p) FROM b JOIN o USING (x)) AS base, (SELECT avg(y) FROM r) AS share)
SELECT 'linear' AS method, vec_id, {sql.rounded('slope * (x - mean)', 5)} AS phi FROM r, s, m
UNION ALL SELECT 'tree', vec_id, {sql.rounded('4 * (p - share)', 5)} FROM r JOIN o USING (x), m
UNION ALL SELECT 'sampled', vec_id, {sql.rounded('p - base', 5)} FROM r JOIN o USING (x), m"""


QUERIES = {
    "q53_ranked_file": q53_ranked_file,
    "q54_metrics_file": q54_metrics_file,
    "q54b_confusion_files": q54b_confusion_files,
    "q55_saved_features": q55_saved_features,
    "q56_model_input": q56_model_input,
    "q57_explained": q57_explained,
}
ORACLES = {
    "q53_ranked_file": Q24,
    "q54_metrics_file": Q54,
    "q54b_confusion_files": Q54B,
    "q55_saved_features": Q29,
    "q56_model_input": Q56,
    "q57_explained": Q57,
}
