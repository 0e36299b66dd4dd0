"""Cohort, windowed averages, flags, assembly, quality reports, table and CSV round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import completed_years, elapsed_days, fahrenheit_to_celsius
from ..operators.assemble import assemble
from ..operators.cohort import capped_age, first_per_group
from ..operators.flags import code_flags
from ..operators.quality import (
    class_distribution, flag_totals, missing_counts, null_report, rate_by, row_counts, shape, value_shares,
)
from ..operators.windowed import windowed_averages
from ..session import shared_dir
from ..sources import read_csv, write_csv, write_table
from ..specs import CodeFlag, Measure
from . import sql
from .tables import table

AS_OF = "2001-12-31 12:00:00"
MIN_YEARS = 3
MAX_YEARS = 5.4

PART_FLAGS = (
    CodeFlag("mid_range", (("ECO", "MED"),)),
    CodeFlag("promo", (("PRO", "PRO"),)),
    CodeFlag("standard", (("STA", "STA"),)),
    CodeFlag("any_flag", (("ECO", "MED"), ("PRO", "PRO"), ("STA", "STA"))),
)
EVENT_MEASURES = (
    Measure("vc", ("view", "click"), -10, 45),
    Measure("pu", ("purchase",), 1, 300),
    Measure("er", ("error",), 0.1, 200, 3),
)
LINE_MEASURES = (
    Measure("line1", (1,), 2, 45),
    Measure("line2", (2,), 1, 50),
    Measure("line3", (3,), 5, 40, 3),
    Measure("line45", (4, 5), 2, 48),
    Measure("line67", (6, 7), 1, 30, 3),
)
LINE_DAYS = 90


def q01_cohort(spark: SparkSession, d: str) -> DataFrame:
    orders, customer, nation = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return (
        orders.where(F.col("o_orderdate").isNotNull() & F.col("o_totalprice").isNotNull())
        .where(completed_years(F.col("o_orderdate"), as_of) >= MIN_YEARS)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey", "c_custkey", "n_name", "o_orderpriority",
            capped_age(F.col("o_orderdate"), as_of, MAX_YEARS).cast("double").alias("age"),
        )
    )


Q01 = f"""SELECT o_orderkey, c_custkey, n_name, o_orderpriority,
  CAST(CAST(least(date_part('year', age(TIMESTAMP '{AS_OF}', o_orderdate)), {MAX_YEARS}) AS decimal(5,1)) AS double) AS age
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE date_part('year', age(TIMESTAMP '{AS_OF}', o_orderdate)) >= {MIN_YEARS}
  AND o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL"""


def q02_first_per_group(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_group(orders, "o_custkey", "o_orderkey")


Q02 = """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders a
WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderkey < a.o_orderkey)"""


def q02b_first_with_ties(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return first_per_group(lines, "l_orderkey", "l_linenumber")


Q02B = """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber < a.l_linenumber)"""


def q03_code_flags(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    coded = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return code_flags(coded, "l_orderkey", "p_type", PART_FLAGS)


Q03 = f"""SELECT l_orderkey, {sql.flags(PART_FLAGS, 'p_type')}
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""


def q04_window_pivot(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    signups = events.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("t0"))
    return windowed_averages(
        events, signups, key="user_id", code="event_type", at="ts", value="value", start="t0",
        measures=EVENT_MEASURES,
        convert=lambda code, v: F.when(code.isin("view", "click"), fahrenheit_to_celsius(v)).otherwise(v),
    )


Q04 = f"""WITH base AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'signup' GROUP BY user_id),
raw AS (
  SELECT b.user_id, e.event_type,
    CASE WHEN e.event_type IN ('view', 'click') THEN (e.value - 32.0) * 5.0 / 9.0 ELSE e.value END AS v
  FROM events e JOIN base b ON e.user_id = b.user_id
  WHERE e.value > 0 AND e.ts >= b.t0 AND e.ts <= b.t0 + INTERVAL 24 HOURS
    AND e.event_type IN ({sql.code_list(EVENT_MEASURES)}))
SELECT user_id, {sql.averages(EVENT_MEASURES, 'event_type', 'v')} FROM raw GROUP BY user_id"""


def q05_window_pivot_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return windowed_averages(
        lines, orders, key="l_orderkey", code="l_linenumber", at="l_shipdate", value="l_quantity",
        start="o_orderdate", measures=LINE_MEASURES, hours=LINE_DAYS * 24,
    )


Q05 = f"""SELECT l_orderkey, {sql.averages(LINE_MEASURES, 'l_linenumber', 'l_quantity')}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber IN ({sql.code_list(LINE_MEASURES)}) AND l_quantity > 0
  AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL {LINE_DAYS} DAYS
GROUP BY l_orderkey"""

_MEASURE_NAMES = [m.name for m in LINE_MEASURES]
_FLAG_NAMES = [f.name for f in PART_FLAGS]


def q06_assemble(spark: SparkSession, d: str) -> DataFrame:
    base = q01_cohort(spark, d).withColumnRenamed("o_orderkey", "l_orderkey").drop("o_orderpriority", "not_there")
    return assemble(
        base,
        [("l_orderkey", q05_window_pivot_lines(spark, d)), ("l_orderkey", q03_code_flags(spark, d))],
        ["l_orderkey", "c_custkey", "n_name", "age", *_MEASURE_NAMES, *_FLAG_NAMES],
        fill=dict.fromkeys(_FLAG_NAMES, 0),
    )


Q06 = f"""WITH base AS ({Q01}), lines AS ({Q05}), marks AS ({Q03})
SELECT o_orderkey AS l_orderkey, c_custkey, n_name, age, {', '.join(_MEASURE_NAMES)},
  {', '.join(f'CAST(coalesce({f}, 0) AS smallint) AS {f}' for f in _FLAG_NAMES)}
FROM base LEFT JOIN lines ON o_orderkey = lines.l_orderkey LEFT JOIN marks ON o_orderkey = marks.l_orderkey"""


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    """All documents with their labels where there are any: a wide table with missing values."""
    documents = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, d, "labels"), "doc_id", "left")


LABELLED = """SELECT doc_id, lang, source, n_chars, quality, toxic
FROM documents LEFT JOIN labels USING (doc_id)"""


def q07_class_dist(spark: SparkSession, d: str) -> DataFrame:
    return class_distribution(labelled_documents(spark, d), "toxic")


Q07 = f"""SELECT toxic, count(*) AS n, {sql.rounded('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct
FROM ({LABELLED}) GROUP BY toxic"""


def q08_sublabel_sums(spark: SparkSession, d: str) -> DataFrame:
    return flag_totals(q03_code_flags(spark, d), {f: f"{f}_n" for f in _FLAG_NAMES})


Q08 = f"""SELECT {', '.join(f'CAST(sum({f}) AS bigint) AS {f}_n' for f in _FLAG_NAMES)} FROM ({Q03})"""


def q09_outcome_rate(spark: SparkSession, d: str) -> DataFrame:
    return rate_by(labelled_documents(spark, d), "toxic", "quality")


Q09 = f"""SELECT toxic, CAST(sum(quality) AS bigint) AS events, count(*) AS total,
  {sql.rounded('sum(quality) * 100.0 / count(*)', 2)} AS rate_pct
FROM ({LABELLED}) GROUP BY toxic"""


def q10_missing(spark: SparkSession, d: str) -> DataFrame:
    return missing_counts(labelled_documents(spark, d), ["lang", "n_chars", "quality", "toxic"])


Q10 = f"""SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}_null' for c in ('lang', 'n_chars', 'quality', 'toxic'))}
FROM ({LABELLED})"""

_COUNTED = ("orders", "lineitem", "events", "documents", "labels")


def q10b_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return row_counts({t: table(spark, d, t) for t in _COUNTED})


Q10B = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in _COUNTED)


def q11_los(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    # The line number adds a share of a day, since all dates are at midnight.
    shipped = F.col("l_shipdate") + F.col("l_linenumber") * F.expr("INTERVAL '61' MINUTE")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        elapsed_days(F.col("o_orderdate"), shipped, 4).cast("double").alias("days"),
    )


Q11 = f"""SELECT l_orderkey, l_linenumber, l_partkey,
  {sql.rounded("epoch(l_shipdate + l_linenumber * INTERVAL '61' MINUTE - o_orderdate) / 86400.0", 4)} AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def q12_null_report(spark: SparkSession, d: str) -> DataFrame:
    return null_report(labelled_documents(spark, d))


Q12 = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls,"
    f" {sql.rounded(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)', 1)} AS pct FROM ({LABELLED})"
    for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
) + ") WHERE nulls > 0"


def q12b_shape(spark: SparkSession, d: str) -> DataFrame:
    return shape(labelled_documents(spark, d))


Q12B = f"SELECT count(*) AS rows, 6 AS columns FROM ({LABELLED})"


def q13_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return value_shares(labelled_documents(spark, d), "toxic")


Q13 = f"""SELECT * FROM (
  SELECT toxic, count(*) AS count, {sql.rounded('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct
  FROM ({LABELLED}) GROUP BY toxic) WHERE toxic IS NOT NULL"""


def q26_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    orders, path = table(spark, d, "orders"), shared_dir(spark)
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


def q26b_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    events, path = table(spark, d, "events"), shared_dir(spark)
    write_table(events, path)
    return spark.read.schema(events.schema).parquet(path)


QUERIES = {
    "q01_cohort": q01_cohort,
    "q02_first_per_group": q02_first_per_group,
    "q02b_first_with_ties": q02b_first_with_ties,
    "q03_code_flags": q03_code_flags,
    "q04_window_pivot": q04_window_pivot,
    "q05_window_pivot_lines": q05_window_pivot_lines,
    "q06_assemble": q06_assemble,
    "q07_class_dist": q07_class_dist,
    "q08_sublabel_sums": q08_sublabel_sums,
    "q09_outcome_rate": q09_outcome_rate,
    "q10_missing": q10_missing,
    "q10b_row_counts": q10b_row_counts,
    "q11_los": q11_los,
    "q12_null_report": q12_null_report,
    "q12b_shape": q12b_shape,
    "q13_value_counts": q13_value_counts,
    "q26_csv_roundtrip": q26_csv_roundtrip,
    "q26b_table_roundtrip": q26b_table_roundtrip,
}
ORACLES = {
    "q01_cohort": Q01,
    "q02_first_per_group": Q02,
    "q02b_first_with_ties": Q02B,
    "q03_code_flags": Q03,
    "q04_window_pivot": Q04,
    "q05_window_pivot_lines": Q05,
    "q06_assemble": Q06,
    "q07_class_dist": Q07,
    "q08_sublabel_sums": Q08,
    "q09_outcome_rate": Q09,
    "q10_missing": Q10,
    "q10b_row_counts": Q10B,
    "q11_los": Q11,
    "q12_null_report": Q12,
    "q12b_shape": Q12B,
    "q13_value_counts": Q13,
    "q26_csv_roundtrip": "SELECT * FROM orders",
    "q26b_table_roundtrip": "SELECT * FROM events",
}
