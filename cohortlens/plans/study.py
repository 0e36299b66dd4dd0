"""The whole study in order: build the dataset, report on it, train, explain."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame

from ..operators.cohort import icu_cohort
from ..session import scratch
from ..sources import write_csv, write_table
from . import explaining, training
from .dataset import assemble_parts, build_parts, quality_reports


def run(
    tables: Mapping[str, DataFrame],
    out: str,
    estimators: Mapping[str, Estimator] | None = None,
    explain_rows: int | None = None,
    group: str | None = None,
) -> None:
    """Write everything under ``out``; each step reads what the step before has stored.

    With ``group``, a column such as ``subject_id``, no group is on both sides of the split. Tables stored
    on the way elsewhere are deleted in the end.
    """
    spark = next(iter(tables.values())).sparkSession
    with scratch(spark):
        _run(spark, tables, out, estimators, explain_rows, group)


def _run(spark, tables, out, estimators, explain_rows, group) -> None:
    def stored(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    base = stored(icu_cohort(tables["patients"], tables["admissions"], tables["icustays"]), "cohort")
    parts = {name: stored(df, name) for name, df in build_parts(tables, base).items()}
    dataset = stored(assemble_parts(base, parts), "dataset")
    write_csv(dataset, f"{out}/dataset_csv")
    for name, report in quality_reports(dataset, {"cohort": base, **parts}).items():
        write_csv(report, f"{out}/reports/{name}")
    training.store(training.train(dataset, estimators=estimators, group=group), out)
    best = PipelineModel.load(f"{out}/best_model")
    explaining.store(explaining.explain_pipeline(best, dataset, rows=explain_rows), out)
