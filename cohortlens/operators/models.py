"""The three classifiers, fitted and scored with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..session import materialize, spread
from ..specs import SEED
from .encode import FittedFeatures, fit_features
from .metrics import evaluate
from .stats import class_weights, with_weights

# Hyper-parameters of the three classifiers.
LOGISTIC_ITERATIONS = 2000
INVERSE_PENALTY = 1.0
FOREST_TREES = 300
FOREST_DEPTH = 12
FOREST_LEAF_ROWS = 5
BOOSTING_ROUNDS = 200
BOOSTING_DEPTH = 4
LEARNING_RATE = 0.05
ROUND_SAMPLE = 0.8

# Statistics that every running task holds in a pass over the data, on the heap that Spark does not manage; less
# means more passes for a deep forest, each with fewer trees. A constant, as the passes decide which features a node tries.
NODE_MEMORY_MB = 128

WEIGHT = "weight"


def logistic_regression(total_weight: float, inverse_penalty: float = INVERSE_PENALTY) -> LogisticRegression:
    """L2-penalised, class-balanced. Spark averages the loss over the total weight, so the penalty
    of a summed loss, 1 / inverse_penalty, is divided by that weight."""
    return LogisticRegression(
        maxIter=LOGISTIC_ITERATIONS, regParam=1.0 / (inverse_penalty * total_weight), elasticNetParam=0.0,
        standardization=False, weightCol=WEIGHT, labelCol="label", featuresCol="features",
    )


def random_forest(trees: int = FOREST_TREES, depth: int = FOREST_DEPTH) -> RandomForestClassifier:
    """Class-balanced forest. Rows keep the node they have reached in each tree, one integer, instead of walking
    down all trees again in every pass; the trees are the same."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=FOREST_LEAF_ROWS, featureSubsetStrategy="sqrt",
        weightCol=WEIGHT, seed=SEED, labelCol="label", featuresCol="features", maxMemoryInMB=NODE_MEMORY_MB,
        cacheNodeIds=True,
    )


def gradient_boosting(rounds: int = BOOSTING_ROUNDS, depth: int = BOOSTING_DEPTH) -> GBTClassifier:
    """Unweighted boosting on row samples."""
    return GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=LEARNING_RATE, subsamplingRate=ROUND_SAMPLE,
        seed=SEED, labelCol="label", featuresCol="features",
    )


def default_estimators(total_weight: float) -> dict[str, Estimator]:
    return {
        "Logistic Regression": logistic_regression(total_weight),
        "Random Forest": random_forest(),
        "Gradient Boosting": gradient_boosting(),
    }


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add the predicted class (``prediction``) and the positive class' probability (``score``)."""
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1])


@dataclass
class TrainedModels:
    """Fitted pipelines by model name with their test metrics and scored test rows."""

    performance: DataFrame
    pipelines: dict[str, PipelineModel] = field(default_factory=dict)
    scored: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def best(self) -> str:
        """Highest ROC-AUC; the earlier model wins a tie."""
        return best_model(self.performance).first()["model"]


def train_and_evaluate(
    train: DataFrame,
    test: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    row_id: str,
    estimators: Mapping[str, Estimator] | None = None,
) -> TrainedModels:
    """Fit features and models on ``train`` and measure them on ``test``.

    The assembled training vectors are kept on executors for all fits. Scored test rows keep only
    what the metrics read and are stored, so no metric scores them again.
    """
    labelled = train.withColumn("label", F.col(label).cast("int"))
    features = fit_features(labelled, numeric, categorical)
    weights = class_weights(labelled, "label")
    assembled = PipelineModel(stages=features.stages)
    weighted = with_weights(assembled.transform(labelled), "label", weights, WEIGHT)
    vectors = spread(weighted.select("features", "label", WEIGHT)).persist(StorageLevel.MEMORY_AND_DISK)
    if estimators is None:
        estimators = default_estimators(vectors.agg(F.sum(WEIGHT)).first()[0])
    test_vectors = assembled.transform(test.withColumn("label", F.col(label).cast("int"))).select(
        row_id, "features", "label"
    )
    trained = TrainedModels(performance=None)
    for place, (name, estimator) in enumerate(estimators.items()):
        model = estimator.fit(vectors)
        trained.pipelines[name] = as_pipeline(features, model)
        scored = score(model, test_vectors).select(row_id, "label", "prediction", "score")
        trained.scored[name] = materialize(scored)
        row = evaluate(trained.scored[name], name).withColumn("place", F.lit(place))
        trained.performance = row if trained.performance is None else trained.performance.unionByName(row)
    vectors.unpersist()
    return trained


def as_pipeline(features: FittedFeatures, model: Model) -> PipelineModel:
    """Feature stages and classifier as one pipeline that saves and loads as a unit."""
    return PipelineModel(stages=[*features.stages, model])


def best_model(performance: DataFrame) -> DataFrame:
    """The row with the highest ROC-AUC, first listed wins ties."""
    return performance.orderBy(F.desc("roc_auc"), "place").limit(1)


def all_scores(scored: Mapping[str, DataFrame]) -> DataFrame:
    """Scored rows of all models under one another, with a ``model`` column."""
    frames = [df.withColumn("model", F.lit(name)) for name, df in scored.items()]
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df)
    return result
