"""Encoding, imputation, scaling, splitting, sampling, weights and the feature matrix."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import half_up
from ..operators.encode import feature_names, fit_features, label_encode, ordinal_encode
from ..operators.ranking import sorted_codes
from ..operators.sampling import fixed_sample, stratified_split
from ..operators.stats import class_weights, distributed_medians, fills_and_scales, medians, modes, with_weights
from . import sql
from .relational import LABELLED, labelled_documents
from .tables import table

SAMPLE_ROWS = 1000


def gappy_customers(spark: SparkSession, d: str) -> DataFrame:
    segment = F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", segment.alias("segment"))


def q14_label_encode(spark: SparkSession, d: str) -> DataFrame:
    return label_encode(gappy_customers(spark, d), "segment")


Q14 = """WITH filled AS (
  SELECT c_custkey, coalesce(CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END, 'nan') AS s FROM customer)
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY s) - 1 AS integer) AS segment FROM filled"""


def q14b_ordinal_unknown(spark: SparkSession, d: str) -> DataFrame:
    rows = labelled_documents(spark, d)
    codes = sorted_codes(rows.where(F.col("toxic") == 1), "source")
    return ordinal_encode(rows, codes, "source", "code").select("doc_id", "code")


Q14B = f"""WITH t AS ({LABELLED}),
codes AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM t WHERE toxic = 1))
SELECT doc_id, CAST(coalesce(code, -1) AS integer) AS code FROM t LEFT JOIN codes USING (source)"""


def gappy_documents(spark: SparkSession, d: str) -> DataFrame:
    return labelled_documents(spark, d).select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang"), "source",
        F.when(F.col("source") != "src3", F.col("n_chars")).alias("n_chars"), "quality", "toxic",
    )


GAPPY = f"""SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, source,
  CASE WHEN source <> 'src3' THEN n_chars END AS n_chars, quality, toxic FROM ({LABELLED})"""


def q15_median_impute(spark: SparkSession, d: str) -> DataFrame:
    rows = gappy_documents(spark, d)
    centre = medians(rows, ["n_chars", "quality"])
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(c) for c, m in centre.items()]
    return rows.select("doc_id", *filled)


Q15 = f"""WITH t AS ({GAPPY}),
m AS (SELECT quantile_cont(CAST(n_chars AS double), 0.5) AS a, quantile_cont(CAST(quality AS double), 0.5) AS b FROM t)
SELECT doc_id, coalesce(CAST(n_chars AS double), (SELECT a FROM m)) AS n_chars,
  coalesce(CAST(quality AS double), (SELECT b FROM m)) AS quality FROM t"""

_LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def q15b_distributed_median(spark: SparkSession, d: str) -> DataFrame:
    found = distributed_medians(table(spark, d, "lineitem"), _LINE_NUMBERS)
    return found.select("column", half_up(F.col("median"), 6).alias("median"))


Q15B = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {sql.rounded(f'quantile_cont({c}, 0.5)', 6)} AS median FROM lineitem"
    for c in _LINE_NUMBERS
)


def q16_standard_scale(spark: SparkSession, d: str) -> DataFrame:
    rows = gappy_documents(spark, d)
    scaled = [
        half_up((F.coalesce(F.col(c).cast("double"), F.lit(fill)) - mean) / deviation, 6).alias(c)
        for c, (fill, mean, deviation) in fills_and_scales(rows, ["n_chars", "quality"]).items()
    ]
    return rows.select("doc_id", *scaled)


Q16 = f"""WITH filled AS ({Q15}),
s AS (SELECT avg(n_chars) AS ma, stddev_pop(n_chars) AS sa, avg(quality) AS mb, stddev_pop(quality) AS sb FROM filled)
SELECT doc_id, {sql.rounded('(n_chars - (SELECT ma FROM s)) / (SELECT sa FROM s)', 6)} AS n_chars,
  {sql.rounded('(quality - (SELECT mb FROM s)) / (SELECT coalesce(nullif(sb, 0), 1) FROM s)', 6)} AS quality FROM filled"""


def q17_mode_impute(spark: SparkSession, d: str) -> DataFrame:
    rows = gappy_documents(spark, d)
    return rows.select("doc_id", F.coalesce("lang", F.lit(modes(rows, ["lang"])["lang"])).alias("lang"))


Q17 = f"""WITH t AS ({GAPPY}),
m AS (SELECT lang FROM t WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT doc_id, coalesce(lang, (SELECT lang FROM m)) AS lang FROM t"""


def q18_strat_split(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return stratified_split(labels, "toxic", "doc_id", order=F.expr(sql.number("doc_id"))).select(
        "doc_id", "toxic", "split"
    )


Q18 = f"""WITH c AS (SELECT toxic, count(*) AS k, sum(count(*)) OVER () AS n FROM labels GROUP BY toxic),
s AS (SELECT *, n - CAST(ceil(n / 5.0) AS bigint) AS n_train FROM c),
f AS (SELECT *, CAST(n_train * k AS bigint) // CAST(n AS bigint) AS low, CAST(n_train * k AS bigint) % CAST(n AS bigint) AS rest FROM s),
z AS (SELECT toxic, k - low - CASE WHEN row_number() OVER (ORDER BY rest DESC, toxic) <= n_train - sum(low) OVER () THEN 1 ELSE 0 END AS n_test FROM f),
r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {sql.number('doc_id')}, doc_id) AS place FROM labels)
SELECT doc_id, toxic, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split FROM r JOIN z USING (toxic)"""


def q25_fixed_sample(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return fixed_sample(orders, SAMPLE_ROWS, "o_orderkey", order=F.expr(sql.number("o_orderkey")))


Q25 = f"""SELECT o_orderkey, o_totalprice FROM orders
ORDER BY {sql.number('o_orderkey')}, o_orderkey LIMIT {SAMPLE_ROWS}"""


def q28_class_weights(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "toxic")
    weighted = with_weights(labels, "toxic", class_weights(labels, "toxic"))
    return weighted.withColumn("weight", half_up(F.col("weight"), 9))


Q28 = f"""SELECT doc_id, toxic, {sql.rounded('n / (2.0 * k)', 9)} AS weight
FROM labels JOIN (SELECT toxic, count(*) AS k, sum(count(*)) OVER () AS n FROM labels GROUP BY toxic) USING (toxic)"""


def q29_feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Fitted on labelled documents, applied to all, the vector spread over plain columns."""
    rows = gappy_documents(spark, d)
    fitted = fit_features(rows.where(F.col("toxic").isNotNull()), ["n_chars", "quality"], ["lang", "source"])
    matrix = PipelineModel(stages=fitted.stages).transform(rows).withColumn("_v", vector_to_array("features"))
    columns = [half_up(F.col("_v")[i], 6).alias(n) for i, n in enumerate(feature_names(fitted.stages))]
    return matrix.select("doc_id", *columns)


Q29 = f"""WITH t AS ({GAPPY}), train AS (SELECT * FROM t WHERE toxic IS NOT NULL),
m AS (SELECT quantile_cont(CAST(n_chars AS double), 0.5) AS a, quantile_cont(CAST(quality AS double), 0.5) AS b FROM train),
filled AS (SELECT coalesce(CAST(n_chars AS double), (SELECT a FROM m)) AS x, coalesce(CAST(quality AS double), (SELECT b FROM m)) AS y FROM train),
s AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy FROM filled),
ml AS (SELECT lang FROM train WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1),
cl AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS code FROM (SELECT DISTINCT lang FROM train WHERE lang IS NOT NULL)),
cs AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM train))
SELECT t.doc_id,
  {sql.rounded('(coalesce(CAST(t.n_chars AS double), (SELECT a FROM m)) - (SELECT mx FROM s)) / (SELECT sx FROM s)', 6)} AS n_chars,
  {sql.rounded('(coalesce(CAST(t.quality AS double), (SELECT b FROM m)) - (SELECT my FROM s)) / (SELECT coalesce(nullif(sy, 0), 1) FROM s)', 6)} AS quality,
  CAST(coalesce(cl.code, -1) AS double) AS lang, CAST(coalesce(cs.code, -1) AS double) AS source
FROM t LEFT JOIN cl ON cl.lang = coalesce(t.lang, (SELECT lang FROM ml)) LEFT JOIN cs ON cs.source = t.source"""

QUERIES = {
    "q14_label_encode": q14_label_encode,
    "q14b_ordinal_unknown": q14b_ordinal_unknown,
    "q15_median_impute": q15_median_impute,
    "q15b_distributed_median": q15b_distributed_median,
    "q16_standard_scale": q16_standard_scale,
    "q17_mode_impute": q17_mode_impute,
    "q18_strat_split": q18_strat_split,
    "q25_fixed_sample": q25_fixed_sample,
    "q28_class_weights": q28_class_weights,
    "q29_feature_matrix": q29_feature_matrix,
}
ORACLES = {
    "q14_label_encode": Q14,
    "q14b_ordinal_unknown": Q14B,
    "q15_median_impute": Q15,
    "q15b_distributed_median": Q15B,
    "q16_standard_scale": Q16,
    "q17_mode_impute": Q17,
    "q18_strat_split": Q18,
    "q25_fixed_sample": Q25,
    "q28_class_weights": Q28,
    "q29_feature_matrix": Q29,
}
