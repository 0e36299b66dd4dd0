"""Edge rows of the clinical dataset, each with the value the definitions demand."""

from datetime import datetime as dt, timedelta
from decimal import Decimal

import pytest

from cohortlens.operators.cohort import first_per_group, icu_cohort
from cohortlens.operators.windowed import windowed_averages
from cohortlens.plans.dataset import build_dataset, diagnosis_flags, labs_first_day, vitals_first_day
from cohortlens.specs import DATASET_COLUMNS, Measure

SCHEMAS = {
    "patients": "subject_id long, gender string, dob timestamp_ntz",
    "admissions": "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz,"
    " hospital_expire_flag short, admission_type string, ethnicity string",
    "icustays": "hadm_id long, icustay_id long, intime timestamp_ntz, outtime timestamp_ntz, los double,"
    " first_careunit string",
    "diagnoses_icd": "hadm_id long, icd9_code string",
    "chartevents": "icustay_id long, itemid int, charttime timestamp_ntz, valuenum double, error int",
    "labevents": "hadm_id long, itemid int, charttime timestamp_ntz, valuenum double",
}
T0 = dt(2020, 1, 1, 8)
H = timedelta(hours=1)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def stay(hadm, icu, intime=T0, outtime=T0 + 50 * H, los=2.0):
    return (hadm, icu, intime, outtime, los, "CCU")


def admission(subject, hadm, admit, discharge="default"):
    return (subject, hadm, admit, admit + 36 * H if discharge == "default" else discharge, 0, "EMERGENCY", "X")


def cohort(spark, patients, admissions, stays):
    return icu_cohort(
        table(spark, "patients", patients), table(spark, "admissions", admissions), table(spark, "icustays", stays)
    )


@pytest.mark.parametrize(
    "dob, admit, age",
    [
        (dt(2000, 6, 15), dt(2018, 6, 15), 18.0),
        (dt(2000, 6, 15), dt(2018, 6, 14, 23, 59), None),
        (dt(1980, 1, 1, 6), dt(2000, 1, 1, 5), 19.0),
        (dt(2000, 2, 29), dt(2018, 2, 28), None),
        (dt(1800, 1, 1), dt(2100, 1, 1), 91.4),
        (dt(1950, 1, 1), dt(2041, 6, 1), 91.0),
        (dt(1949, 1, 1), dt(2041, 6, 1), 91.4),
    ],
)
def test_age(spark, dob, admit, age):
    rows = cohort(spark, [(1, "F", dob)], [admission(1, 10, admit)], [stay(10, 100)]).collect()
    assert [float(r["age"]) for r in rows] == ([] if age is None else [age])


def kept(spark, stays, admissions=None):
    rows = cohort(spark, [(1, "F", dt(1950, 1, 1))], admissions or [admission(1, 10, T0)], stays).collect()
    return sorted(r["icustay_id"] for r in rows)


def test_lowest_stay_wins_over_earliest(spark):
    assert kept(spark, [stay(10, 200, T0), stay(10, 100, T0 + 10 * H)]) == [100]


def test_open_stay_is_removed_before_choosing(spark):
    assert kept(spark, [stay(10, 100, outtime=None), stay(10, 200)]) == [200]


def test_tied_stays_are_all_kept(spark):
    assert kept(spark, [stay(10, 100), stay(10, 100), stay(10, 101)]) == [100, 100]


def test_open_admission_is_dropped(spark):
    assert kept(spark, [stay(10, 100)], [admission(1, 10, T0, None)]) == []


def test_first_per_group_keeps_null_keys(spark):
    rows = [(1, 10), (1, 11), (1, 10), (2, 7), (3, None), (1, None), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "g long, o long")
    kept_rows = sorted((tuple(r) for r in first_per_group(df, "g", "o").collect()), key=str)
    assert kept_rows == sorted([(1, 10), (1, 10), (2, 7), (3, None), (1, None), (None, 5), (None, 6)], key=str)


def test_lengths_of_stay(spark):
    row = cohort(spark, [(1, "F", dt(1950, 1, 1))], [admission(1, 10, T0)], [stay(10, 100, los=1.00005)]).first()
    assert row["hosp_los_days"] == Decimal("1.5000")
    assert row["icu_los_days"] == Decimal("1.0001")


def test_diagnosis_prefixes(spark):
    codes = ["41401", "4270", "428", "415", "41", "V4581", None]
    rows = diagnosis_flags(table(spark, "diagnoses_icd", list(enumerate(codes)))).orderBy("hadm_id").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (1, 0, 0, 1), (0, 1, 0, 1), (0, 0, 1, 1), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0),
    ]


def base(spark, stays=((10, 100),)):
    rows = [(h, i, T0) for h, i in stays]
    return spark.createDataFrame(rows, "hadm_id long, icustay_id long, icu_intime timestamp_ntz")


def vitals(spark, events, stays=((10, 100),)):
    return vitals_first_day(table(spark, "chartevents", events), base(spark, stays)).collect()


def test_window_bounds_are_inclusive(spark):
    at = [T0 - timedelta(seconds=1), T0, T0 + 24 * H, T0 + 24 * H + timedelta(seconds=1)]
    rows = vitals(spark, [(100, 211, t, 10.0 * (i + 6), None) for i, t in enumerate(at)])
    assert rows[0]["heart_rate"] == 75.0


def test_fahrenheit_is_converted(spark):
    rows = vitals(spark, [(100, 678, T0, 98.6, None), (100, 676, T0, 38.0, None)])
    assert rows[0]["temp_celsius"] == 37.5


def test_raw_value_must_be_positive(spark):
    rows = vitals(spark, [(100, 678, T0, 0.0, None), (100, 678, T0, -4.0, None), (100, 211, T0, 80.0, None)])
    assert (rows[0]["temp_celsius"], rows[0]["heart_rate"]) == (None, 80.0)


def test_error_rows_are_left_out(spark):
    rows = vitals(spark, [(100, 211, T0, 60.0, None), (100, 211, T0, 80.0, 0), (100, 211, T0, 200.0, 1)])
    assert rows[0]["heart_rate"] == 70.0


def test_range_is_inclusive(spark):
    rows = vitals(spark, [(100, 646, T0, v, None) for v in (50.0, 100.0, 101.0)])
    assert rows[0]["spo2"] == 75.0


def test_implausible_events_give_a_row_of_nulls(spark):
    rows = vitals(spark, [(100, 211, T0, 400.0, None)], [(10, 100), (11, 101)])
    assert len(rows) == 1 and rows[0]["icustay_id"] == 100
    assert all(v is None for v in tuple(rows[0])[1:])


def test_labs_count_from_intensive_care_admission(spark):
    events = [(10, 50912, T0 - H, 1.0), (10, 50912, T0 + H, 2.0), (None, 50912, T0 + H, 9.0)]
    rows = labs_first_day(table(spark, "labevents", events), base(spark)).collect()
    assert [(r["hadm_id"], r["creatinine"]) for r in rows] == [(10, 2.0)]


def test_average_rounds_half_up(spark):
    events = spark.createDataFrame([(1, "p", T0, 80.45), (1, "p", T0, 80.5)], "k long, c string, t timestamp_ntz, v double")
    windows = spark.createDataFrame([(1, T0)], "k long, s timestamp_ntz")
    rows = windowed_averages(events, windows, "k", "c", "t", "v", "s", [Measure("p", ("p",), 1, 300)]).collect()
    assert rows[0]["p"] == 80.48


def test_several_windows_of_one_key_weigh_their_events(spark):
    """Like a join: an event counts once for every window of its key it falls into."""
    events = spark.createDataFrame(
        [(1, "p", T0 + H, 10.0), (1, "p", T0 + 30 * H, 40.0)], "k long, c string, t timestamp_ntz, v double"
    )
    windows = spark.createDataFrame([(1, T0), (1, T0), (1, T0 + 10 * H)], "k long, s timestamp_ntz")
    rows = windowed_averages(events, windows, "k", "c", "t", "v", "s", [Measure("p", ("p",), 1, 300)]).collect()
    assert rows[0]["p"] == 20.0  # 10, 10 and 40


def test_windows_before_1970(spark):
    start = dt(1969, 12, 31, 20)
    events = spark.createDataFrame(
        [(1, "p", start + i * H, 10.0 + i) for i in (-1, 0, 5, 24, 25)], "k long, c string, t timestamp_ntz, v double"
    )
    windows = spark.createDataFrame([(1, start)], "k long, s timestamp_ntz")
    rows = windowed_averages(events, windows, "k", "c", "t", "v", "s", [Measure("p", ("p",), 1, 300)]).collect()
    assert rows[0]["p"] == round((10 + 15 + 34) / 3, 2)


def test_dataset_keeps_cohort_rows_and_fills_labels(spark):
    tables = {
        "patients": table(spark, "patients", [(1, "F", dt(1950, 1, 1)), (2, None, dt(1960, 1, 1))]),
        "admissions": table(spark, "admissions", [admission(1, 10, T0), admission(2, 20, T0)]),
        "icustays": table(spark, "icustays", [stay(10, 100), stay(20, 200), stay(20, 201)]),
        "diagnoses_icd": table(spark, "diagnoses_icd", [(10, "41401")]),
        "chartevents": table(spark, "chartevents", [(100, 211, T0, 80.0, None)]),
        "labevents": table(spark, "labevents", [(10, 51006, T0, 12.0)]),
    }
    for cut in (True, False):
        df = build_dataset(tables, cut_lineage=cut)
        assert df.columns == list(DATASET_COLUMNS) and len(df.columns) == 35
        first, second = df.orderBy("hadm_id").collect()
        assert (first["heart_rate"], first["bun"], first["ischemic_hd"], first["heart_disease"]) == (80.0, 12.0, 1, 1)
        assert second["icustay_id"] == 200
        assert (second["heart_rate"], second["bun"], second["ischemic_hd"], second["heart_disease"]) == (None, None, 0, 0)


def test_flags_stay_short(spark):
    flags = diagnosis_flags(table(spark, "diagnoses_icd", [(10, "428")]))
    assert {t for c, t in flags.dtypes if c != "hadm_id"} == {"smallint"}


def test_the_dataset_joins_lines_and_dates_once(spark, monkeypatch, tmp_path):
    """Stays, chart and lab events read the stored lines; diagnoses, which need no dates, do not."""
    from cohortlens.queries import clinical
    from cohortlens.queries.tables import SCHEMAS

    days = "timestamp_ntz'2001-02-03 04:00:00' + make_dt_interval(CAST(id % 50 AS int))"
    made = {
        "customer": "id, 'c', 1, 0D, 'm'", "part": "id, 'p', 'b', 'PROMO', 3, 1D",
        "orders": f"id, id % 7, 'P', id * 9000D, {days}, '1-URGENT'",
        "lineitem": f"id % 30, id % 11, id % 5, CAST(id % 4 AS int), id * 1D, 1D, 0D, 0.05D, 'A', 'F', {days}",
    }
    for name, columns in made.items():
        names = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        spark.range(40).selectExpr(f"INLINE(ARRAY(STRUCT({columns})))").toDF(*names).write.parquet(f"{tmp_path}/{name}.parquet")
    stored = []
    monkeypatch.setattr(clinical, "materialize", lambda df: stored.append(df) or df)
    tables = clinical.clinical_tables(spark, str(tmp_path), stored_lines=True)
    assert len(stored) == 1 and tuple(stored[0].columns) == clinical._DATED_COLUMNS
    plain = clinical.clinical_tables(spark, str(tmp_path))
    assert len(stored) == 1
    for name, df in tables.items():
        assert df.schema == plain[name].schema and df.exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(df).isEmpty()
    assert tables["labevents"].count() > 0
