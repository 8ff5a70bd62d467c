"""Logistic regression in numpy, for models fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftmart.session import materialise


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights + self.bias

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(rows))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Logistic:
    """Newton steps on standardised features. With one class only, the model is that class's smoothed share."""
    n, k = rows.shape
    share = (labels.sum() + 0.5) / (n + 1) if n else 0.0
    flat = Logistic(np.zeros(k), np.ones(k), np.zeros(k), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    if n == 0 or labels.min() == labels.max():
        return flat
    mean, scale = rows.mean(0), rows.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.hstack([(rows - mean) / scale, np.ones((n, 1))])
    w = np.zeros(k + 1)
    w[-1] = flat.bias
    keep = np.full(k + 1, ridge)
    keep[-1] = 1e-6
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - labels * z).sum() + (keep * w * w).sum() / 2)

    at = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (labels - p) - keep * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        # halve the step until it helps
        size = 1.0
        while size > 1e-6 and not (now := loss(w + size * step)) < at:
            size /= 2
        if size <= 1e-6:
            break
        w, gain, at = w + size * step, at - now, now
        if gain < 1e-9 * max(1.0, at):
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


def label_sample(labels: DataFrame, column: str, bound: int, id_column: str = "doc_id") -> DataFrame:
    """``(id, label)`` of at most ``bound`` labelled ids, the same ones on every run.

    Rows without id or label are left out; of several labels of an id the more frequent one counts, 1 on a tie.
    """
    some = labels.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{column}`").cast("double").alias("label"))
    some = some.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    return materialise(some.orderBy(F.xxhash64("id"), "id").limit(bound), "labels")
