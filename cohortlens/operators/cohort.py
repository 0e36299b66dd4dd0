"""Cohort selection and first-record-per-group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import completed_years, elapsed_days
from ..specs import ADULT_YEARS, AGE_CAP


def capped_age(born: Column, at: Column, cap: float = AGE_CAP) -> Column:
    """Completed years, capped, with one decimal. Only ages above the cap change."""
    return F.least(completed_years(born, at).cast("decimal(5,1)"), F.lit(cap).cast("decimal(5,1)"))


def first_per_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """Rows holding the smallest ``order`` of their group; ties and rows with a NULL key stay.

    The minimum is aggregated before the shuffle, and the rows are then matched on (group, minimum)
    instead of being ranked in one window per group, so a group of any size spreads over many tasks.
    """
    lowest = df.groupBy(group).agg(F.min(order).alias(order)).withColumn("_lowest", F.lit(True))
    matched = df.join(lowest, [group, order], "left")
    return matched.where(F.col("_lowest") | F.col(group).isNull() | F.col(order).isNull()).select(df.columns)


def icu_cohort(patients: DataFrame, admissions: DataFrame, stays: DataFrame) -> DataFrame:
    """Adult admissions with a completed stay: one row per admission, its lowest stay id.

    Stay selection looks at the stays alone: the other conditions hold for a whole admission, so
    picking the stay before the joins gives the same rows and joins far fewer of them.
    """
    first_stays = first_per_group(stays.where(F.col("outtime").isNotNull()), "hadm_id", "icustay_id")
    adults = (
        admissions.where(F.col("dischtime").isNotNull())
        .join(patients, "subject_id")
        .where(completed_years(F.col("dob"), F.col("admittime")) >= ADULT_YEARS)
    )
    return adults.join(first_stays, "hadm_id").select(
        "subject_id",
        "hadm_id",
        "icustay_id",
        "gender",
        capped_age(F.col("dob"), F.col("admittime")).alias("age"),
        "admittime",
        "dischtime",
        F.col("intime").alias("icu_intime"),
        F.col("outtime").alias("icu_outtime"),
        F.round(F.col("los").cast("decimal(28,10)"), 4).alias("icu_los_days"),
        elapsed_days(F.col("admittime"), F.col("dischtime"), 4).alias("hosp_los_days"),
        "hospital_expire_flag",
        "first_careunit",
        "admission_type",
        "ethnicity",
    )
