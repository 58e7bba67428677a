"""Small models shared by the classifiers: logistic regression and calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(features: np.ndarray, target: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first feature is the constant one."""
    weight = np.ones(len(target)) if weight is None else weight
    penalty = np.full(features.shape[1], ridge)
    penalty[0] = 1e-3
    beta = np.zeros(features.shape[1])
    for _ in range(30):
        p = sigmoid(features @ beta)
        slope = features.T @ (weight * (p - target)) + penalty * beta
        curve = (features * (weight * p * (1 - p))[:, None]).T @ features + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return beta
