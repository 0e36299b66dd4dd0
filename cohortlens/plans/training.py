"""From the wide table to trained, measured and stored models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from ..functions import slug
from ..operators.encode import split_by_type
from ..operators.metrics import class_report, confusion, roc_curve
from ..operators.models import TrainedModels, all_scores, train_and_evaluate
from ..operators.sampling import grouped_split, stratified_split
from ..session import materialize
from ..sources import write_csv
from ..specs import ID_COLUMNS, SUB_LABELS, TARGET

GENDER = "gender"


def prepare(dataset: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Model input: the parts of the target removed, and the two kinds of features.

    Gender counts as numeric: the fitted pipeline holds its label codes. Identifiers stay in the table to tell rows apart but are no features. The outcome flag and the
    lengths of stay are features; drop them first if they are not known at prediction time.
    """
    frame = dataset.drop(*SUB_LABELS).withColumn(TARGET, F.col(TARGET).cast("int"))
    numeric, categorical = split_by_type(frame, exclude=(*ID_COLUMNS, TARGET))
    numeric = [c for c in frame.columns if c in numeric or (c == GENDER and c in categorical)]
    return frame, numeric, [c for c in categorical if c != GENDER]


def train(
    dataset: DataFrame,
    row_id: str = "icustay_id",
    estimators: Mapping[str, Estimator] | None = None,
    group: str | None = None,
) -> TrainedModels:
    """Exact stratified split, then the models; feature statistics come from training rows only.

    With ``group`` (say, the patient) all rows of a group are on one side of the split.
    """
    frame, numeric, categorical = prepare(dataset)
    split = grouped_split(frame, TARGET, group) if group else stratified_split(frame, TARGET, row_id)
    split = materialize(split)
    return train_and_evaluate(
        split.where(F.col("split") == "train"), split.where(F.col("split") == "test"),
        numeric, categorical, TARGET, row_id, estimators,
    )


def store_metrics(performance: DataFrame, scored: Mapping[str, DataFrame], out: str) -> None:
    """Metrics table, ROC points, confusion grids and class reports of scored models under ``out``."""
    write_csv(performance.drop("place"), f"{out}/model_performance")
    write_csv(roc_curve(all_scores(scored), by="model"), f"{out}/roc_all_models")
    for name, rows in scored.items():
        write_csv(confusion(rows), f"{out}/confusion_{slug(name)}")
        write_csv(class_report(rows), f"{out}/class_report_{slug(name)}")


def store(trained: TrainedModels, out: str) -> None:
    """The metrics of all models and the best pipeline under ``out``."""
    store_metrics(trained.performance, trained.scored, out)
    trained.pipelines[trained.best].write().overwrite().save(f"{out}/best_model")
