"""The whole study on derived clinical tables, with small models."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortlens.operators import models
from cohortlens.plans import explaining, study, training
from cohortlens.queries.clinical import clinical_tables
from cohortlens.sources import load_tables, read_csv, read_table, write_csv
from cohortlens.specs import DATASET_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("study"))
    estimators = {
        "Logistic Regression": models.logistic_regression(1000.0),
        "Random Forest": models.random_forest(5, 4),
        "Gradient Boosting": models.gradient_boosting(4, 3),
    }
    study.run(clinical_tables(spark, SF), path, estimators, explain_rows=120)
    return path


def test_dataset_has_28_features(spark, out):
    dataset = spark.read.parquet(f"{out}/dataset")
    assert dataset.columns == list(DATASET_COLUMNS)
    _, numeric, categorical = training.prepare(dataset)
    assert len(numeric) == 25 and sorted(categorical) == ["admission_type", "ethnicity", "first_careunit"]


def test_csv_copy_equals_the_table(spark, out):
    dataset = spark.read.parquet(f"{out}/dataset")
    copy = read_csv(spark, f"{out}/dataset_csv", dataset.schema)
    assert copy.exceptAll(dataset).count() == 0 and copy.count() == dataset.count()


def test_reports(spark, out):
    rows = spark.read.parquet(f"{out}/dataset").count()
    classes = spark.read.csv(f"{out}/reports/class_distribution", header=True, inferSchema=True).collect()
    assert sum(r["n"] for r in classes) == rows
    counted = {r["table"]: r["n"] for r in spark.read.csv(f"{out}/reports/rows", header=True, inferSchema=True).collect()}
    assert counted.pop("dataset") == counted["cohort"] == rows
    assert counted == {name: spark.read.parquet(f"{out}/{name}").count() for name in counted} and len(counted) == 4
    report = spark.read.csv(f"{out}/class_report_random_forest", header=True, inferSchema=True).collect()
    assert [r["class"] for r in report] == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    outcome = spark.read.csv(f"{out}/reports/outcome_rate", header=True, inferSchema=True).collect()
    assert sum(r["total"] for r in outcome) == rows


def test_models_and_explanation(spark, out):
    table = spark.read.csv(f"{out}/model_performance", header=True, inferSchema=True)
    assert table.columns == ["model", "accuracy", "precision", "recall", "f1_score", "roc_auc"] and table.count() == 3
    top = spark.read.csv(f"{out}/top_features", header=True, inferSchema=True).orderBy("rank").collect()
    assert [r["rank"] for r in top] == list(range(1, 16))
    assert [r["mean_abs_shap"] for r in top] == sorted((r["mean_abs_shap"] for r in top), reverse=True)
    swarm = spark.read.parquet(f"{out}/beeswarm")
    assert swarm.count() == 120 * 20 and swarm.select("feature").distinct().count() == 20
    roc = spark.read.csv(f"{out}/roc_all_models", header=True, inferSchema=True)
    assert roc.select("model").distinct().count() == 3


def test_whole_dataset_can_be_explained(spark, out):
    dataset = spark.read.parquet(f"{out}/dataset")
    best = PipelineModel.load(f"{out}/best_model")
    explained = explaining.explain_pipeline(best, dataset)
    assert isinstance(explained.base, float)
    assert explained.rows.count() == dataset.count()


def test_missing_input_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path), "nothing")
    with pytest.raises(Exception, match="(?i)does not exist"):
        PipelineModel.load(str(tmp_path / "nothing"))


def test_csv_keeps_quotes_and_reads_empty_fields_as_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\\'), (2, None), (3, "")], "id int, s string")
    write_csv(df, str(tmp_path / "c"))
    back = {r["id"]: r["s"] for r in read_csv(spark, str(tmp_path / "c"), df.schema).collect()}
    assert back == {1: 'a "b", c\\', 2: None, 3: None}


def test_csv_keeps_white_space(spark, tmp_path):
    rows = {1: "  led", 2: "trailed \t", 3: " ", 4: "in  side"}
    df = spark.createDataFrame(list(rows.items()), "id int, s string")
    write_csv(df, str(tmp_path / "w"))
    assert {r["id"]: r["s"] for r in read_csv(spark, str(tmp_path / "w"), df.schema).collect()} == rows


def test_tables_load_by_name(spark):
    assert set(load_tables(spark, SF, ["region", "nation"])) == {"region", "nation"}


def test_no_patient_on_both_sides_and_nothing_left_behind(spark, tmp_path):
    """With a group the study's test rows share no patient with the others; its scratch tables are gone."""
    import os

    from cohortlens import session

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    before = set(os.listdir(root.removeprefix("file:")))
    only = {"Logistic Regression": models.logistic_regression(1000.0)}
    study.run(clinical_tables(spark, SF), str(tmp_path / "s"), only, explain_rows=20, group="subject_id")
    assert set(os.listdir(root.removeprefix("file:"))) <= before
    dataset = spark.read.parquet(str(tmp_path / "s" / "dataset"))
    trained = training.train(dataset, estimators=only, group="subject_id")
    tested = trained.scored["Logistic Regression"].select("icustay_id").distinct()
    sides = dataset.join(tested.withColumn("tested", F.lit(1)), "icustay_id", "left").groupBy("subject_id").agg(F.countDistinct(F.coalesce("tested", F.lit(0))).alias("n"))
    assert sides.where("n > 1").count() == 0 and tested.count() > 0
    assert session._made  # of runs that were not cleaned up
