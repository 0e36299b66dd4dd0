"""The wide clinical table: cohort, first-day vitals and labs, diagnosis flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fahrenheit_to_celsius
from ..operators.assemble import assemble
from ..operators.cohort import icu_cohort
from ..operators.flags import code_flags
from ..operators.quality import (
    class_distribution, flag_totals, missing_counts, null_report, rate_by, row_counts, shape, value_shares,
)
from ..operators.windowed import windowed_averages
from ..session import materialize
from ..specs import (
    DATASET_COLUMNS, DIAGNOSES, FAHRENHEIT_ITEMS, LABS, MISSING_CHECKED, OUTCOME, SUB_LABELS, TARGET, VITALS,
)

SOURCE_TABLES = ("patients", "admissions", "icustays", "diagnoses_icd", "chartevents", "labevents")


def celsius(item: Column, value: Column) -> Column:
    """Values of the Fahrenheit items in Celsius, all others unchanged."""
    return F.when(item.isin(list(FAHRENHEIT_ITEMS)), fahrenheit_to_celsius(value)).otherwise(value)


def vitals_first_day(chartevents: DataFrame, base: DataFrame, stored_base: bool = False) -> DataFrame:
    return windowed_averages(
        chartevents, base, key="icustay_id", code="itemid", at="charttime", value="valuenum", start="icu_intime",
        measures=VITALS, convert=celsius, valid=F.coalesce(F.col("error"), F.lit(0)) == 0, stored_windows=stored_base,
    )


def labs_first_day(labevents: DataFrame, base: DataFrame, stored_base: bool = False) -> DataFrame:
    """Keyed by admission, but the day starts when intensive care does."""
    return windowed_averages(
        labevents, base, key="hadm_id", code="itemid", at="charttime", value="valuenum",
        start="icu_intime", measures=LABS, stored_windows=stored_base,
    )


def diagnosis_flags(diagnoses: DataFrame) -> DataFrame:
    return code_flags(diagnoses, "hadm_id", "icd9_code", DIAGNOSES)


def build_dataset(tables: Mapping[str, DataFrame], cut_lineage: bool = True) -> DataFrame:
    """The dataset with its 35 columns, one row per cohort row.

    The cohort feeds three branches; with ``cut_lineage`` it is written once to the shared folder, so
    it is not recomputed per branch and its file size tells Catalyst whether to broadcast it to the
    event tables or to shuffle both.
    """
    base = icu_cohort(tables["patients"], tables["admissions"], tables["icustays"])
    if cut_lineage:
        base = materialize(base)
    return assemble_parts(base, build_parts(tables, base, cut_lineage))


def build_parts(tables: Mapping[str, DataFrame], base: DataFrame, stored_base: bool = True) -> dict[str, DataFrame]:
    """The tables that are joined to the cohort ``base``."""
    return {
        "first_day_vitals": vitals_first_day(tables["chartevents"], base, stored_base),
        "first_day_labs": labs_first_day(tables["labevents"], base, stored_base),
        "diagnosis_flags": diagnosis_flags(tables["diagnoses_icd"]),
    }


def assemble_parts(base: DataFrame, parts: Mapping[str, DataFrame]) -> DataFrame:
    keys = {"first_day_vitals": "icustay_id", "first_day_labs": "hadm_id", "diagnosis_flags": "hadm_id"}
    joined = [(key, parts[name]) for name, key in keys.items()]
    return assemble(base, joined, DATASET_COLUMNS, fill={flag.name: 0 for flag in DIAGNOSES})


def quality_reports(dataset: DataFrame, parts: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The checks and summaries that accompany a build; store the dataset and its parts first."""
    totals = {**{c: f"{c}_n" for c in SUB_LABELS}, TARGET: f"any_{TARGET}_n"}
    return {
        "rows": row_counts({**(parts or {}), "dataset": dataset}),
        "shape": shape(dataset),
        "class_distribution": class_distribution(dataset, TARGET),
        "sub_labels": flag_totals(dataset, totals),
        "outcome_rate": rate_by(dataset, TARGET, OUTCOME),
        "missing": missing_counts(dataset, MISSING_CHECKED),
        "null_report": null_report(dataset),
        "target_shares": value_shares(dataset, TARGET),
        "outcome_shares": value_shares(dataset, OUTCOME),
    }
