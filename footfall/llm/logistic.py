"""Logistic regression on the driver, for matrices of bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """A matrix as (row, column, value) triples."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    shape: tuple[int, int]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.columns], self.shape[0])

    def back(self, s: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * s[self.rows], self.shape[1])


def logistic(x: Sparse, y: np.ndarray, penalty: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient descent. Deterministic."""
    n, k = x.shape
    w, b = np.zeros(k), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    ahead, ahead_b, pace = w, b, 1.0
    v = np.ones(k) / max(k, 1) ** 0.5
    for _ in range(20):  # the largest curvature
        v = x.back(x.times(v))
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1 / (0.25 * (np.linalg.norm(x.times(v)) ** 2 / n + 1) + penalty)
    for _ in range(steps):
        slope = 1 / (1 + np.exp(-np.clip(x.times(ahead) + ahead_b, -500, 500))) - y
        new_w = ahead - rate * (x.back(slope) / n + penalty * ahead)
        new_b = ahead_b - rate * slope.mean()
        new_pace = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = new_w + (pace - 1) / new_pace * (new_w - w)
        ahead_b = new_b + (pace - 1) / new_pace * (new_b - b)
        w, b, pace = new_w, new_b, new_pace
    return w, b
