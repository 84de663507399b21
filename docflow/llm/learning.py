"""What the classifiers share: folds, labelled samples, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most about this many rows of each kind go to the driver to fit a classifier, drawn by hash; a documented bound.
SAMPLE_ROWS = 20_000


def fold(id_: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(folds))


def drawn(df: DataFrame, key: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer) by a hash of ``key``; the same ones each time."""
    total = df.count()
    return df if total <= rows else df.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * rows / total))


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression, by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), decay * max(len(x), 1))
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + penalty * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
