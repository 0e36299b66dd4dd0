"""Metrics on deterministic scores, so every figure has an exact SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import half_up
from ..operators.metrics import class_metrics, class_report, confusion, evaluate, roc_auc, roc_curve
from ..operators.models import all_scores, best_model
from . import sql
from .tables import table

LONG_TEXT = 2000


def scored_documents(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents scored by length."""
    documents = table(spark, d, "documents").select("doc_id", "n_chars")
    return table(spark, d, "labels").join(documents, "doc_id").select(
        "doc_id", F.col("toxic").alias("label"), F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > LONG_TEXT).cast("int").alias("prediction"),
    )


SCORED = f"""SELECT doc_id, toxic AS label, CAST(n_chars AS double) AS score,
  CASE WHEN n_chars > {LONG_TEXT} THEN 1 ELSE 0 END AS prediction FROM labels JOIN documents USING (doc_id)"""


def scored_lines(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Line items as rows of two models: is the line returned, by price and by quantity."""
    lines = table(spark, d, "lineitem")
    label = (F.col("l_returnflag") == "R").cast("int").alias("label")
    by_price = lines.select(label, F.col("l_extendedprice").alias("score"), (F.col("l_extendedprice") > 50000).cast("int").alias("prediction"))
    by_quantity = lines.select(label, F.col("l_quantity").alias("score"), (F.col("l_quantity") > 30).cast("int").alias("prediction"))
    return {"price": by_price, "quantity": by_quantity}


LINES = """SELECT 'price' AS model, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS score,
  CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS prediction FROM lineitem
UNION ALL SELECT 'quantity', CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, l_quantity,
  CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END FROM lineitem"""


def cells(rows: str) -> str:
    return f"""SELECT
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS double) AS tp,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS double) AS fp,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS double) AS fn,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS double) AS tn FROM ({rows})"""


def share(part: str, whole: str) -> str:
    return f"coalesce(({part}) / nullif({whole}, 0), 0.0)"


def q19_confusion(spark: SparkSession, d: str) -> DataFrame:
    return confusion(scored_documents(spark, d))


Q19 = f"""SELECT y AS label, p AS prediction, count(t.label) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(y, p) LEFT JOIN ({SCORED}) t ON t.label = y AND t.prediction = p GROUP BY y, p"""


def q20_prf(spark: SparkSession, d: str) -> DataFrame:
    return class_metrics(scored_documents(spark, d))


PRF = ", ".join(
    f"{sql.rounded(share(a, b), 4)} AS {n}"
    for n, a, b in (
        ("accuracy", "tp + tn", "tp + tn + fp + fn"),
        ("precision", "tp", "tp + fp"),
        ("recall", "tp", "tp + fn"),
        ("f1_score", "2 * tp", "2 * tp + fp + fn"),
    )
)
Q20 = f"SELECT {PRF} FROM ({cells(SCORED)})"


def q20b_class_report(spark: SparkSession, d: str) -> DataFrame:
    return class_report(scored_documents(spark, d))


def _report() -> str:
    p0, r0, f0 = share("tn", "tn + fn"), share("tn", "tn + fp"), share("2 * tn", "2 * tn + fp + fn")
    p1, r1, f1 = share("tp", "tp + fp"), share("tp", "tp + fn"), share("2 * tp", "2 * tp + fp + fn")
    acc, n0, n1, n = share("tp + tn", "tp + tn + fp + fn"), "(tn + fp)", "(tp + fn)", "(tn + fp + tp + fn)"
    lines = [
        ("0", p0, r0, f0, n0),
        ("1", p1, r1, f1, n1),
        ("accuracy", acc, acc, acc, n),
        ("macro avg", *[f"({a} + {b}) / 2" for a, b in ((p0, p1), (r0, r1), (f0, f1))], n),
        ("weighted avg", *[f"({a} * {n0} + {b} * {n1}) / {n}" for a, b in ((p0, p1), (r0, r1), (f0, f1))], n),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS class, {sql.rounded(p, 4)} AS precision, {sql.rounded(r, 4)} AS recall,"
        f" {sql.rounded(f, 4)} AS f1_score, CAST({s} AS bigint) AS support FROM c"
        for name, p, r, f, s in lines
    )


Q20B = f"WITH c AS ({cells(SCORED)}) {_report()}"


def auc_sql(rows: str, by: str = "") -> str:
    """Area from mid-ranks."""
    keys = f"{by}, " if by else ""
    group = f"PARTITION BY {by} " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    area = "(sum(pos * r) - sum(pos) * (sum(pos) + 1) / 2.0) / (CAST(sum(pos) AS double) * sum(k - pos))"
    return f"""SELECT {keys}{sql.rounded(area, 9)} AS roc_auc
FROM (SELECT {keys}pos, k, sum(k) OVER ({group}ORDER BY score) - (k - 1) / 2.0 AS r
  FROM (SELECT {keys}score, count(*) AS k, count(*) FILTER (WHERE label = 1) AS pos FROM ({rows}) GROUP BY {keys}score)){tail}"""


def curve_sql(rows: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"PARTITION BY {by} " if by else ""
    return f"""WITH g AS (SELECT {keys}score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM ({rows}) GROUP BY {keys}score)
SELECT {keys}threshold,
  {sql.rounded(f'CAST(sum(neg) OVER ({group}ORDER BY threshold DESC) AS double) / sum(neg) OVER ({group})', 9)} AS fpr,
  {sql.rounded(f'CAST(sum(pos) OVER ({group}ORDER BY threshold DESC) AS double) / sum(pos) OVER ({group})', 9)} AS tpr FROM g
UNION ALL SELECT DISTINCT {keys}CAST('Infinity' AS double), 0.0, 0.0 FROM g"""


def _nine_digits(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), 9) for c in columns})


def q21_auc(spark: SparkSession, d: str) -> DataFrame:
    return _nine_digits(roc_auc(scored_documents(spark, d)), "roc_auc")


def q21b_auc_all_models(spark: SparkSession, d: str) -> DataFrame:
    return _nine_digits(roc_auc(all_scores(scored_lines(spark, d)), by="model"), "roc_auc")


def q22_roc(spark: SparkSession, d: str) -> DataFrame:
    return _nine_digits(roc_curve(scored_documents(spark, d)), "fpr", "tpr")


def q22b_roc_all_models(spark: SparkSession, d: str) -> DataFrame:
    return _nine_digits(roc_curve(all_scores(scored_lines(spark, d)), by="model"), "fpr", "tpr")


def q27b_best_model(spark: SparkSession, d: str) -> DataFrame:
    """Metric rows of several models under one another and the choice among them."""
    rows = [
        evaluate(scored, name).withColumn("place", F.lit(i))
        for i, (name, scored) in enumerate(scored_lines(spark, d).items())
    ]
    return best_model(rows[0].unionByName(rows[1])).drop("place")


PERFORMANCE = " UNION ALL ".join(
    f"SELECT '{m}' AS model, {PRF}, {sql.rounded(f'(SELECT roc_auc FROM a WHERE model = {chr(39)}{m}{chr(39)})', 4)} AS roc_auc, {i} AS place"
    f" FROM ({cells(f'SELECT * FROM l WHERE model = {chr(39)}{m}{chr(39)}')})"
    for i, m in enumerate(("price", "quantity"))
)
Q27B = f"""WITH l AS ({LINES}), a AS ({auc_sql('SELECT * FROM l', 'model')})
SELECT model, accuracy, precision, recall, f1_score, roc_auc FROM ({PERFORMANCE}) ORDER BY roc_auc DESC, place LIMIT 1"""

QUERIES = {
    "q19_confusion": q19_confusion,
    "q20_prf": q20_prf,
    "q20b_class_report": q20b_class_report,
    "q21_auc": q21_auc,
    "q21b_auc_all_models": q21b_auc_all_models,
    "q22_roc": q22_roc,
    "q22b_roc_all_models": q22b_roc_all_models,
    "q27b_best_model": q27b_best_model,
}
ORACLES = {
    "q19_confusion": Q19,
    "q20_prf": Q20,
    "q20b_class_report": Q20B,
    "q21_auc": auc_sql(SCORED),
    "q21b_auc_all_models": auc_sql(LINES, "model"),
    "q22_roc": curve_sql(SCORED),
    "q22b_roc_all_models": curve_sql(LINES, "model"),
    "q27b_best_model": Q27B,
}
