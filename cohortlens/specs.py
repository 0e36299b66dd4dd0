"""Declarative specs: which codes form a measure or a flag, and the shipped clinical example."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Measure:
    """Average of the values of ``codes`` inside [low, high], rounded to ``scale`` decimals."""

    name: str
    codes: tuple
    low: float
    high: float
    scale: int = 2


@dataclass(frozen=True)
class CodeFlag:
    """1 if any code has a prefix inside one of the closed string ranges ``spans``."""

    name: str
    spans: tuple[tuple[str, str], ...]


# Item codes, plausibility ranges, rounding and diagnosis prefixes of the clinical
# data model. They must stay as they are for results to mean the same thing.
VITALS = (
    Measure("heart_rate", (211, 220045), 20, 300),
    Measure("sbp", (51, 442, 455, 220050, 220179), 40, 300),
    Measure("dbp", (8368, 8440, 8441, 220051, 220180), 20, 200),
    Measure("mbp", (52, 443, 456, 220052, 220181, 225312), 20, 250),
    Measure("spo2", (646, 220277), 50, 100),
    Measure("resp_rate", (618, 220210, 224690), 4, 60),
    Measure("temp_celsius", (676, 678, 223761, 223762), 25, 45),
)
FAHRENHEIT_ITEMS = (678, 223761)
LABS = (
    Measure("creatinine", (50912,), 0.1, 30, 3),
    Measure("bun", (51006,), 1, 300),
    Measure("sodium", (50983,), 100, 180),
    Measure("potassium", (50971,), 1.5, 10, 3),
    Measure("chloride", (50902,), 70, 130),
    Measure("bicarbonate", (50882,), 5, 50),
    Measure("calcium_total", (50893,), 1, 20, 3),
    Measure("glucose", (50931,), 30, 1500),
    Measure("platelet", (51265,), 10, 1500),
    Measure("wbc", (51301,), 0.5, 500, 3),
    Measure("hemoglobin", (51222,), 2, 25, 3),
    Measure("hematocrit", (51221,), 5, 75),
    Measure("lactate", (50813,), 0.1, 30, 3),
)
DIAGNOSES = (
    CodeFlag("ischemic_hd", (("410", "414"),)),
    CodeFlag("dysrhythmia", (("427", "427"),)),
    CodeFlag("heart_failure", (("428", "428"),)),
    CodeFlag("heart_disease", (("410", "414"), ("427", "427"), ("428", "428"))),
)
ADULT_YEARS = 18
AGE_CAP = 91.4
WINDOW_HOURS = 24
ID_COLUMNS = ("subject_id", "hadm_id", "icustay_id")
DEMOGRAPHICS = ("gender", "age", "ethnicity", "admission_type", "first_careunit")
STAY_COLUMNS = ("icu_los_days", "hosp_los_days")
SUB_LABELS = ("ischemic_hd", "dysrhythmia", "heart_failure")
TARGET = "heart_disease"
OUTCOME = "hospital_expire_flag"
MISSING_CHECKED = (
    "heart_rate", "sbp", "dbp", "mbp", "spo2", "resp_rate", "temp_celsius",
    "creatinine", "bun", "sodium", "lactate",
)
TEST_FRACTION = 0.2
SEED = 42
TOP_FEATURES = 15
BEESWARM_FEATURES = 20
BACKGROUND_ROWS = 200

DATASET_COLUMNS = (
    *ID_COLUMNS,
    *DEMOGRAPHICS,
    *STAY_COLUMNS,
    *(m.name for m in VITALS),
    *(m.name for m in LABS),
    *(d.name for d in DIAGNOSES),
    OUTCOME,
)
