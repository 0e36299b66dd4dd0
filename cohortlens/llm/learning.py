"""What the two classifiers share: a bounded labelled sample and a logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import remainder

THRESHOLD = 0.7


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, divisor: int, held_out: int, rows: int) -> DataFrame:
    """doc_id, text, label of about ``rows`` labelled documents, never one of the held-out remainder.

    Labels are chosen by a hash of the identifier and at most twice ``rows`` of them are joined, so the
    broadcast side is bounded whatever the size of the tables. Null labels and identifiers teach nothing;
    a document with several labels takes the largest.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label"))
    known = known.dropna().where(remainder(F.col("doc_id"), divisor) != held_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    near = known.where(F.pmod(F.xxhash64("doc_id", F.lit(name)), F.lit(1 << 24)) < int(share * (1 << 24)) + 1)
    return docs.join(F.broadcast(near.limit(2 * rows)), "doc_id").select("doc_id", "text", "label")


class Logistic:
    """Ridge-penalised logistic regression on standardised features and their squares, by Newton's method."""

    def __init__(self, features, labels, penalty: float = 0.5):
        x, y = np.asarray(features, float), np.asarray(labels, float)
        self.prior = float((y.sum() + 1) / (len(y) + 2))
        self.fitted = len(y) > 0 and 0 < y.sum() < len(y)
        if not self.fitted:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._expanded(x)
        self.weights = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[0] = 1e-3
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            curve = (z.T * np.maximum(p * (1 - p), 1e-9)) @ z + np.diag(ridge)
            self.weights += np.clip(np.linalg.solve(curve, z.T @ (y - p) - ridge * self.weights), -2, 2)

    def _expanded(self, x):
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.c_[np.ones(len(z)), z, z**2]

    def score(self, features):
        x = np.asarray(features, float)
        if not self.fitted:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._expanded(x) @ self.weights, -30, 30)))
