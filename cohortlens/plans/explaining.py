"""Attribution of a stored or fitted pipeline on the wide table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame

from ..operators.attribution import beeswarm, explain, feature_stages, importance
from ..operators.encode import feature_names
from ..operators.models import score
from ..operators.sampling import fixed_sample
from ..session import materialize
from ..sources import write_ranked, write_table
from ..specs import BEESWARM_FEATURES, TOP_FEATURES
from .training import prepare

ROWS_PER_TASK = 50


@dataclass(frozen=True)
class Explanation:
    """Attributions per row and their base value, their ranking, and the long table behind a summary plot."""

    rows: DataFrame
    base: float
    importance: DataFrame
    beeswarm: DataFrame


def explain_pipeline(
    pipeline: PipelineModel, dataset: DataFrame, row_id: str = "icustay_id", rows: int | None = None, scored: bool = False
) -> Explanation:
    """Explain the whole dataset, or a reproducible sample of ``rows`` rows.

    With ``scored`` each explained row also has the ``score`` that the pipeline gives it, from the same pass.
    Linear attributions are a projection of the stored vectors; the dearer ones of other models are stored.
    """
    frame, _, _ = prepare(dataset)
    if rows is not None:
        # A limited sample is one partition; attribution is heavy enough to spread even that.
        frame = fixed_sample(frame, rows, row_id).repartition(-(-rows // ROWS_PER_TASK), row_id)
    names = feature_names(pipeline.stages)
    keep = ["score"] if scored else []
    featured = score(pipeline, frame) if scored else feature_stages(pipeline).transform(frame)
    vectors = materialize(featured.select(row_id, *keep, "features"))
    model = pipeline.stages[-1]
    explained, base = explain(vectors, model, row_id, keep=keep)
    if not isinstance(model, LogisticRegressionModel):
        explained = materialize(explained)
    return Explanation(
        explained, base, importance(explained, names), beeswarm(explained, names, row_id, BEESWARM_FEATURES)
    )


def store(explanation: Explanation, out: str) -> None:
    write_ranked(explanation.importance, f"{out}/top_features", TOP_FEATURES)
    write_table(explanation.beeswarm, f"{out}/beeswarm")
