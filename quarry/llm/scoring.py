"""Calibration shared by the classifiers: logistic regression on a few
features, fitted on the driver from a bounded sample of feature rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Logistic:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # intercept first

    def __call__(self, features: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1 of rows of features."""
        x = (features - np.array(self.mean)) / np.array(self.scale)
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1, steps: int = 50) -> Logistic:
    """Newton's method with a small ridge. Without rows of both classes the
    score is the constant share of label 1 (0.5 without any rows)."""
    n, k = features.shape
    share = float(labels.mean()) if n else 0.5
    if n == 0 or labels.min() == labels.max():
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Logistic((0.0,) * k, (1.0,) * k, (float(odds),) + (0.0,) * k)
    mean, scale = features.mean(0), features.std(0) + 1e-9
    a = np.c_[np.ones(n), (features - mean) / scale]
    w = np.zeros(k + 1)
    penalty = ridge * np.eye(k + 1)
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - labels) + penalty @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w)))
