import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.metrics import class_metrics, class_report, confusion, evaluate, roc_auc, roc_curve
from cohortlens.operators.ranking import running_totals, top_ranked


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_no_predicted_positives(spark):
    row = class_metrics(scored(spark, [(1, 0, 0.1), (0, 0, 0.2), (0, 0, 0.3)])).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)
    assert row["accuracy"] == 0.6667


def test_empty_cells_are_zero(spark):
    grid = {(r["label"], r["prediction"]): r["n"] for r in confusion(scored(spark, [(1, 1, 0.9)])).collect()}
    assert grid == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_report_has_averages(spark):
    rows = {r["class"]: r for r in class_report(scored(spark, [(1, 1, 0.9), (1, 0, 0.2), (0, 0, 0.1), (0, 0, 0.3)])).collect()}
    assert rows["1"]["recall"] == 0.5 and rows["0"]["recall"] == 1.0
    assert rows["macro avg"]["precision"] == round((1 + 2 / 3) / 2, 4)
    assert rows["weighted avg"]["support"] == 4


def cases():
    rng = random.Random(5)
    # Many ties, few ties, and one score shared by a third of all rows.
    yield [(rng.randint(0, 1), 0, rng.randint(0, 9) / 10) for _ in range(200)]
    yield [(rng.randint(0, 1), 0, rng.random()) for _ in range(200)]
    yield [(rng.randint(0, 1), 0, 0.5 if i % 3 == 0 else rng.random()) for i in range(200)]


@pytest.mark.parametrize("rows", list(cases()))
def test_area_equals_pairs_and_trapezoids(spark, rows):
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    df = scored(spark, rows)
    assert roc_auc(df).first()["roc_auc"] == pytest.approx(pairs, abs=1e-12)
    points = [(r["fpr"], r["tpr"]) for r in roc_curve(df).orderBy(F.desc("threshold")).collect()]
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(pairs, abs=1e-12)


def test_one_class_only_has_no_area(spark):
    assert roc_auc(scored(spark, [(1, 1, 0.9)])).first()["roc_auc"] is None


def test_evaluate_row(spark):
    row = evaluate(scored(spark, [(1, 1, 0.9), (0, 0, 0.1)]), "m").first()
    assert tuple(row) == ("m", 1.0, 1.0, 1.0, 1.0, 1.0)


@pytest.mark.parametrize("slice_rows", [1, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, slice_rows, descending):
    rng = random.Random(1)
    rows = [(g, x * x / 7.0, rng.randint(0, 5)) for g in ("a", "b") for x in rng.sample(range(-50, 400), 60)]
    rows = list({(g, x): (g, x, n) for g, x, n in rows}.values()) + [("a", float("inf"), 2), ("b", float("-inf"), 3)]
    df = spark.createDataFrame(rows, "g string, x double, n int")
    got = running_totals(df, "x", ["n"], ["g"], descending, slice_rows)
    expected = set()
    for g in ("a", "b"):
        total = sum(n for h, _, n in rows if h == g)
        cum = 0
        for _, x, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
            cum += n
            expected.add((g, x, n, cum, total))
    assert set(map(tuple, got.collect())) == expected


def test_running_totals_of_nothing(spark):
    assert running_totals(spark.createDataFrame([], "x double, n int"), "x", ["n"]).collect() == []


def test_ranked_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", 0.0)], "feature string, v double")
    assert [tuple(r) for r in top_ranked(df, "v", "feature", 3).collect()] == [(1, "c", 2.0), (2, "a", 1.0), (3, "b", 1.0)]
