"""The whole clinical dataset on tables of the clinical shape derived from the shared ones.

Each derivation is one SQL text both engines run: customers become patients, orders admissions,
line items stays, chart and lab events and, with their parts, diagnoses. Every source row is used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import half_up
from ..operators import models
from ..operators.quality import class_distribution, flag_totals, missing_counts, null_report, rate_by
from ..plans import training
from ..plans.dataset import build_dataset, diagnosis_flags, labs_first_day, vitals_first_day
from ..plans.explaining import explain_pipeline
from ..operators.cohort import icu_cohort
from ..operators.sampling import grouped_split, stratified_split
from ..session import evenly, materialize
from ..specs import (
    ADULT_YEARS, AGE_CAP, DATASET_COLUMNS, DIAGNOSES, FAHRENHEIT_ITEMS, LABS, MISSING_CHECKED, OUTCOME,
    STAY_COLUMNS, SUB_LABELS, TARGET, VITALS, WINDOW_HOURS,
)
from . import sql
from .tables import table

_VITAL_ITEMS = [c for m in VITALS for c in m.codes]
_LAB_ITEMS = [c for m in LABS for c in m.codes]


# Table names behind FROM and JOIN; Spark gets the tables as arguments, not as views of the session.
_SOURCE = re.compile(r"\b(FROM |JOIN )(customer|orders|lineitem|part|dated_lines)\b")
_DATED = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_DATED_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "o_orderdate")


def _numbered(items: list[int]) -> str:
    return ", ".join(f"({i}, {c})" for i, c in enumerate(items))


DERIVED = {
    "patients": """SELECT c_custkey AS subject_id,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  TIMESTAMP '1900-03-15 06:30:00' + INTERVAL '1' DAY * CAST(c_custkey * 37 % 33000 AS integer) AS dob FROM customer""",
    "admissions": """SELECT o_custkey AS subject_id, o_orderkey AS hadm_id,
  o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 7 % 1440 AS integer) AS admittime,
  CASE WHEN o_orderkey % 19 <> 0
    THEN o_orderdate + INTERVAL '1' MINUTE * CAST(2000 + o_orderkey * 13 % 30000 AS integer) END AS dischtime,
  CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS smallint) AS hospital_expire_flag,
  o_orderpriority AS admission_type,
  CASE WHEN o_totalprice < 100000 THEN 'A' WHEN o_totalprice < 300000 THEN 'B' ELSE 'C' END AS ethnicity FROM orders""",
    "icustays": """SELECT l_orderkey AS hadm_id, l_orderkey * 10 + l_linenumber AS icustay_id,
  o_orderdate + INTERVAL '1' MINUTE * CAST(61 * l_linenumber AS integer) AS intime,
  CASE WHEN l_partkey % 17 <> 0
    THEN o_orderdate + INTERVAL '1' MINUTE * CAST(61 * l_linenumber + 100 * l_quantity AS integer) END AS outtime,
  l_quantity / 7.0 AS los, l_returnflag || l_linestatus AS first_careunit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "diagnoses_icd": """SELECT l_orderkey AS hadm_id,
  CASE WHEN p_type = 'PROMO' AND p_size < 15 THEN '41401' WHEN p_type = 'LARGE' AND p_size < 15 THEN '42731'
    WHEN p_type = 'MEDIUM' AND p_size < 15 THEN '4280' WHEN p_type = 'SMALL' THEN 'V4581'
    WHEN p_type = 'STANDARD' THEN '415' WHEN p_type = 'ECONOMY' THEN NULL ELSE '41' END AS icd9_code
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "chartevents": f"""SELECT l_orderkey * 10 + 1 + l_linenumber % 2 AS icustay_id, itemid,
  o_orderdate + INTERVAL '1' MINUTE * CAST(l_suppkey * 31 % 1700 AS integer) AS charttime,
  CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_quantity * 3.7 - 5.0 END AS valuenum,
  CASE WHEN l_tax < 0.01 THEN 1 WHEN l_tax < 0.03 THEN NULL ELSE 0 END AS error
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN (VALUES {_numbered(_VITAL_ITEMS)}) items(place, itemid) ON l_partkey % {len(_VITAL_ITEMS)} = place""",
    "labevents": f"""SELECT CASE WHEN l_suppkey % 29 <> 0 THEN l_orderkey END AS hadm_id, itemid,
  o_orderdate + INTERVAL '1' MINUTE * CAST(l_suppkey * 17 % 1700 AS integer) AS charttime,
  CASE WHEN l_tax > 0.04 THEN l_quantity * 0.31 ELSE l_quantity * 3.1 END AS valuenum
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN (VALUES {_numbered(_LAB_ITEMS)}) items(place, itemid) ON l_partkey % {len(_LAB_ITEMS)} = place""",
}


def clinical_tables(spark: SparkSession, d: str, stored_lines: bool = False) -> dict[str, DataFrame]:
    """The derived tables. Stays, chart and lab events all read the lines with their orders' dates: with
    ``stored_lines``, for queries that need all three, that join is shuffled once and stored for them."""
    sources = {name: table(spark, d, name) for name in ("customer", "orders", "lineitem", "part")}
    texts = DERIVED
    if stored_lines:
        dated = sources["lineitem"].join(sources["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        sources["dated_lines"] = materialize(dated.select(*_DATED_COLUMNS))
        texts = {name: text.replace(_DATED, "FROM dated_lines") for name, text in DERIVED.items()}
    return {name: spark.sql(_SOURCE.sub(r"\1{\2} AS \2", text), **sources) for name, text in texts.items()}


def clinical_dataset(spark: SparkSession, d: str) -> DataFrame:
    return build_dataset(clinical_tables(spark, d, stored_lines=True))


COHORT = f"""raw_cohort AS (
  SELECT subject_id, hadm_id, icustay_id, gender,
    CAST(CAST(least(date_part('year', age(admittime, dob)), {AGE_CAP}) AS decimal(5,1)) AS double) AS age,
    ethnicity, admission_type, first_careunit, intime,
    {sql.rounded('los', 4)} AS icu_los_days, {sql.rounded('epoch(dischtime - admittime) / 86400.0', 4)} AS hosp_los_days,
    hospital_expire_flag
  FROM patients JOIN admissions USING (subject_id) JOIN icustays USING (hadm_id)
  WHERE date_part('year', age(admittime, dob)) >= {ADULT_YEARS} AND outtime IS NOT NULL AND dischtime IS NOT NULL),
cohort AS (SELECT * FROM raw_cohort a WHERE NOT EXISTS (
  SELECT 1 FROM raw_cohort b WHERE b.hadm_id = a.hadm_id AND b.icustay_id < a.icustay_id))"""


def _first_day(events: str, key: str, value: str, measures, extra: str = "") -> str:
    return f"""SELECT {key}, {sql.averages(measures, 'itemid', 'v')} FROM (
  SELECT e.{key}, itemid, {value} AS v FROM {events} e JOIN cohort c ON e.{key} = c.{key}
  WHERE itemid IN ({sql.code_list(measures)}) AND valuenum > 0
    AND charttime BETWEEN intime AND intime + INTERVAL {WINDOW_HOURS} HOURS{extra}) GROUP BY {key}"""


_CELSIUS = f"CASE WHEN itemid IN ({', '.join(map(str, FAHRENHEIT_ITEMS))}) THEN (valuenum - 32.0) * 5.0 / 9.0 ELSE valuenum END"
SOURCES = ", ".join(f"{name} AS ({text})" for name, text in DERIVED.items())
VITALS_SQL = _first_day("chartevents", "icustay_id", _CELSIUS, VITALS, " AND coalesce(error, 0) = 0")
LABS_SQL = _first_day("labevents", "hadm_id", "valuenum", LABS)
FLAGS_SQL = f"SELECT hadm_id, {sql.flags(DIAGNOSES, 'icd9_code')} FROM diagnoses_icd GROUP BY hadm_id"
_FLAG_NAMES = {f.name for f in DIAGNOSES}
DATASET = f"""WITH {SOURCES}, {COHORT}, vitals AS ({VITALS_SQL}), labs AS ({LABS_SQL}), flags AS ({FLAGS_SQL}),
dataset AS (SELECT {', '.join(f'CAST(coalesce({c}, 0) AS smallint) AS {c}' if c in _FLAG_NAMES else c for c in DATASET_COLUMNS)}
  FROM cohort LEFT JOIN vitals USING (icustay_id) LEFT JOIN labs USING (hadm_id) LEFT JOIN flags USING (hadm_id))"""

_DECIMALS = ("age", *STAY_COLUMNS)


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in _DECIMALS})


def q40_clinical_dataset(spark: SparkSession, d: str) -> DataFrame:
    return _as_doubles(clinical_dataset(spark, d))


def q41_icu_cohort(spark: SparkSession, d: str) -> DataFrame:
    t = clinical_tables(spark, d)
    cohort = _as_doubles(icu_cohort(t["patients"], t["admissions"], t["icustays"]))
    return cohort.drop("admittime", "dischtime", "icu_outtime").withColumnRenamed("icu_intime", "intime")


def q42_first_day_vitals(spark: SparkSession, d: str) -> DataFrame:
    t = clinical_tables(spark, d)
    return vitals_first_day(t["chartevents"], materialize(icu_cohort(t["patients"], t["admissions"], t["icustays"])), stored_base=True)


def q43_first_day_labs(spark: SparkSession, d: str) -> DataFrame:
    t = clinical_tables(spark, d)
    return labs_first_day(t["labevents"], materialize(icu_cohort(t["patients"], t["admissions"], t["icustays"])), stored_base=True)


def q44_diagnosis_flags(spark: SparkSession, d: str) -> DataFrame:
    return diagnosis_flags(clinical_tables(spark, d)["diagnoses_icd"])


def q45_clinical_missing(spark: SparkSession, d: str) -> DataFrame:
    return missing_counts(clinical_dataset(spark, d), MISSING_CHECKED)


def q46_clinical_nulls(spark: SparkSession, d: str) -> DataFrame:
    return null_report(clinical_dataset(spark, d))


def q47_clinical_classes(spark: SparkSession, d: str) -> DataFrame:
    return class_distribution(clinical_dataset(spark, d), TARGET)


def q48_clinical_outcome(spark: SparkSession, d: str) -> DataFrame:
    return rate_by(clinical_dataset(spark, d), TARGET, OUTCOME)


def q49_clinical_sub_labels(spark: SparkSession, d: str) -> DataFrame:
    totals = {**{c: f"{c}_n" for c in SUB_LABELS}, TARGET: f"any_{TARGET}_n"}
    return flag_totals(clinical_dataset(spark, d), totals)


def q50_clinical_split(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the stratified split of a table whose stay ids repeat."""
    split = stratified_split(clinical_dataset(spark, d), TARGET, "icustay_id")
    return split.groupBy(F.col(TARGET).cast("int").alias(TARGET), "split").agg(F.count("*").alias("n"))


def q51_group_split(spark: SparkSession, d: str) -> DataFrame:
    """The sides on which each patient has rows: one."""
    dataset = clinical_dataset(spark, d)
    split = grouped_split(dataset, TARGET, "subject_id", order=F.expr(sql.number("subject_id")))
    return split.select("subject_id", "split").distinct()


def q52_clinical_explained(spark: SparkSession, d: str) -> DataFrame:
    """Training, selection and explanation end to end: per stay, how far base value and attributions are from the
    log-odds that the chosen pipeline gives it. No patient is on both sides of the split."""
    with evenly(spark):
        dataset = materialize(clinical_dataset(spark, d))
        labels = dataset.where(F.col(TARGET).isNotNull())
        # The identity holds after any number of iterations.
        estimator = models.logistic_regression(float(labels.count())).setMaxIter(40)
        trained = training.train(labels, estimators={"Logistic Regression": estimator}, group="subject_id")
        best = trained.pipelines[trained.best]
        explained = explain_pipeline(best, dataset, scored=True)
    margin = F.log(F.col("score") / (1 - F.col("score")))
    added = F.aggregate("phi", F.lit(explained.base), lambda a, v: a + v)
    rows = explained.rows.where(F.col("icustay_id").isNotNull())
    return rows.select("icustay_id", F.abs(half_up(added - margin, 6)).alias("gap"))


def _test_sizes(rows: str) -> str:
    """CTEs that share ceil(n / 5) test rows out among the classes of ``rows`` (label), by largest remainder."""
    return f"""c AS (SELECT label, count(*) AS k, sum(count(*)) OVER () AS n FROM {rows} GROUP BY label),
s AS (SELECT *, n - CAST(ceil(n / 5.0) AS bigint) AS n_train FROM c),
f AS (SELECT *, CAST(n_train * k AS bigint) // CAST(n AS bigint) AS low, CAST(n_train * k AS bigint) % CAST(n AS bigint) AS rest FROM s),
z AS (SELECT label, k, k - low - CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= n_train - sum(low) OVER () THEN 1 ELSE 0 END AS n_test FROM f)"""


Q50 = f"""{DATASET}, l AS (SELECT CAST({TARGET} AS integer) AS label FROM dataset), {_test_sizes('l')}
SELECT label AS {TARGET}, 'test' AS split, CAST(n_test AS bigint) AS n FROM z WHERE n_test > 0
UNION ALL SELECT label, 'train', CAST(k - n_test AS bigint) FROM z WHERE k > n_test"""
Q52 = f"{DATASET} SELECT icustay_id, CAST(0.0 AS double) AS gap FROM dataset"
Q51 = f"""{DATASET}, g AS (SELECT subject_id, max(CAST({TARGET} AS integer)) AS label FROM dataset GROUP BY subject_id), {_test_sizes('g')},
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql.number('subject_id')}, subject_id) AS place FROM g)
SELECT subject_id, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split FROM r JOIN z USING (label)"""

QUERIES = {
    "q50_clinical_split": q50_clinical_split,
    "q51_group_split": q51_group_split,
    "q52_clinical_explained": q52_clinical_explained,
    "q40_clinical_dataset": q40_clinical_dataset,
    "q41_icu_cohort": q41_icu_cohort,
    "q42_first_day_vitals": q42_first_day_vitals,
    "q43_first_day_labs": q43_first_day_labs,
    "q44_diagnosis_flags": q44_diagnosis_flags,
    "q45_clinical_missing": q45_clinical_missing,
    "q46_clinical_nulls": q46_clinical_nulls,
    "q47_clinical_classes": q47_clinical_classes,
    "q48_clinical_outcome": q48_clinical_outcome,
    "q49_clinical_sub_labels": q49_clinical_sub_labels,
}
ORACLES = {
    "q50_clinical_split": Q50,
    "q51_group_split": Q51,
    "q52_clinical_explained": Q52,
    "q40_clinical_dataset": f"{DATASET} SELECT * FROM dataset",
    "q41_icu_cohort": f"WITH {SOURCES}, {COHORT} SELECT * FROM cohort",
    "q42_first_day_vitals": f"WITH {SOURCES}, {COHORT} {VITALS_SQL}",
    "q43_first_day_labs": f"WITH {SOURCES}, {COHORT} {LABS_SQL}",
    "q44_diagnosis_flags": f"WITH {SOURCES} {FLAGS_SQL}",
    "q45_clinical_missing": f"{DATASET} SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}_null' for c in MISSING_CHECKED)} FROM dataset",
    "q46_clinical_nulls": f"{DATASET} SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls,"
        f" {sql.rounded(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)', 1)} AS pct FROM dataset"
        for c in DATASET_COLUMNS
    ) + ") WHERE nulls > 0",
    "q47_clinical_classes": f"{DATASET} SELECT {TARGET}, count(*) AS n, {sql.rounded('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct FROM dataset GROUP BY {TARGET}",
    "q48_clinical_outcome": f"""{DATASET} SELECT {TARGET}, CAST(sum({OUTCOME}) AS bigint) AS events, count(*) AS total,
  {sql.rounded(f'sum({OUTCOME}) * 100.0 / count(*)', 2)} AS rate_pct FROM dataset GROUP BY {TARGET}""",
    "q49_clinical_sub_labels": f"{DATASET} SELECT {', '.join(f'CAST(sum({c}) AS bigint) AS {c}_n' for c in SUB_LABELS)}, CAST(sum({TARGET}) AS bigint) AS any_{TARGET}_n FROM dataset",
}
