"""Small logistic regressions in numpy: a few dense features, standardised."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Logistic:
    """``mean`` and ``scale`` standardise; without weights every prediction is ``base``."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray | None
    bias: float
    base: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.weight is None:
            return np.full(len(x), self.base)
        return sigmoid(((x - self.mean) / self.scale) @ self.weight + self.bias)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 40) -> Logistic:
    """Newton's method with a ridge penalty. One class or no rows: the share of ones."""
    width = x.shape[1] if x.ndim == 2 else 0
    if not len(y) or y.min() == y.max():
        return Logistic(np.zeros(width), np.ones(width), None, 0.0, float(y.mean()) if len(y) else 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.full(width + 1, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(width + 1)
    for _ in range(steps):
        p = sigmoid(z @ w)
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]), float(y.mean()))
