"""Sampled attributions inside tasks: mixed vectors are made and scored batch by batch as arrays."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegressionModel, MultilayerPerceptronClassificationModel

# Numbers in the mixed vectors of one step; keeps a step's arrays within a few tens of MB.
CELLS = 1_000_000

ArrayScorer = Callable[[np.ndarray], np.ndarray]

# What runs in tasks travels by value; the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def array_scorer(model: Model | None) -> ArrayScorer | None:
    """The positive class' probability as a function of a matrix of rows, None for models that only Spark can score."""
    if isinstance(model, LogisticRegressionModel) and model.numClasses == 2:
        slopes, intercept = model.coefficients.toArray(), float(model.intercept)
        return lambda x: logistic(x @ slopes + intercept)
    if isinstance(model, MultilayerPerceptronClassificationModel):
        layers, weights = list(model.getLayers()), model.weights.toArray()
        return lambda x: perceptron(x, layers, weights)[:, 1]
    return None


def logistic(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-z))


def perceptron(x: np.ndarray, layers: list[int], weights: np.ndarray) -> np.ndarray:
    """Class probabilities: logistic layers and a softmax at the end. A layer's weights are stored by input, then its offsets."""
    at = 0
    for k, (n, m) in enumerate(zip(layers, layers[1:])):
        matrix, offset = weights[at : at + n * m].reshape(n, m), weights[at + n * m : at + n * m + m]
        at += n * m + m
        x = x @ matrix + offset
        x = logistic(x) if k < len(layers) - 2 else x
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def walk(scorer: ArrayScorer, background: np.ndarray, x: np.ndarray, seeds: np.ndarray, rounds: int, total: int) -> np.ndarray:
    """For each row of ``x`` the changes that its features make on walks from the background rows, over ``total`` walks.

    A row meets each background row ``rounds`` times, every time with its features in another order, which
    the row's seed decides. Along a walk features switch one by one to the row's values.
    """
    size, phi = x.shape[1], np.zeros(x.shape)
    others = np.tile(background, (rounds, 1))
    step = max(1, CELLS // ((size + 1) * max(1, size)))
    known = np.arange(size + 1)[None, :, None]
    for row, seed, sums in zip(x, seeds.astype(np.uint64), phi):
        rng = np.random.default_rng(int(seed))
        for at in range(0, len(others), step):
            start = others[at : at + step]
            order = np.argsort(rng.random(start.shape), axis=1)
            turn = np.argsort(order, axis=1)
            mixed = np.where(turn[:, None, :] < known, row, start[:, None, :])
            scores = scorer(mixed.reshape(-1, size)).reshape(len(start), size + 1)
            sums += np.bincount(order.reshape(-1), np.diff(scores, axis=1).reshape(-1), size)
    return phi / total
