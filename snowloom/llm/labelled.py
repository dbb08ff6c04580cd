"""What the two classifiers share: folds of documents, labelled rows, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """The remainder of crc32 of the id as text; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, hint: str | None = None) -> DataFrame:
    """``(doc_id, text, y)`` of the usable documents that have a label of 0 or 1.

    ``usable`` is a condition on ``doc_id``; it is applied to both sides, so no other label is read. Of
    repeated labels for one id the larger counts. ``hint`` names the join where its plan shall not depend on
    how many labels there happen to be.
    """
    marks = labels.where(usable & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    marks = marks.select(F.col("doc_id").alias("__id"), "y")
    texts = docs.where(usable).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = marks.hint(hint) if hint else marks
    return texts.join(marks, texts.doc_id == marks["__id"]).select("doc_id", "text", "y")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights for the columns of ``x`` and, last, an intercept, by Newton's method on scaled columns.

    Without both classes the weights are zero and the intercept is far on the side of the class there is,
    or of class 0 if there is none.
    """
    n = x.shape[1] if x.ndim == 2 else 0
    if not len(y) or y.min() == y.max():
        return np.append(np.zeros(n), 8.0 if len(y) and y.min() == 1 else -8.0)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    # A column that does not vary tells nothing.
    spread[spread < 1e-9] = np.inf
    z, w = np.column_stack([(x - mean) / spread, np.ones(len(x))]), np.zeros(n + 1)
    for _ in range(steps):
        p = logistic(z @ w)
        gradient = z.T @ (p - y) + ridge * w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(n + 1), gradient)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
