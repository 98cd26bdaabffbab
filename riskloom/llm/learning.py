"""Small numpy learners and the sampling that feeds them; data reach the driver only as bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 1 << 20


def held_out(key: Column) -> Column:
    """Whether a row's label must not be learnt from: crc32 of the key as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def at_most(df: DataFrame, key: str, bound: int, rows: int, salt: str) -> DataFrame:
    """All of ``df`` if it has at most ``bound`` rows, else about ``bound`` of its ``rows`` rows, chosen by a hash of the key."""
    share = min(1.0, bound / max(rows, 1))
    if share == 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(GRAIN)) < int(share * GRAIN))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one the intercept, without penalty) by Newton steps."""
    rows = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(rows.shape[1], l2)
    penalty[-1] = 1e-6
    w = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = sigmoid(rows @ w)
        slope = rows.T @ (weight * (p - y)) + penalty * w
        curve = (rows * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        norm = np.abs(step).max()
        w -= step * min(1.0, 5.0 / norm) if norm else step
        if norm < 1e-6:
            break
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]
