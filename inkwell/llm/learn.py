"""Small numeric helpers for models that are fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, float]:
    """Newton's method on the regularised log-loss; the bias is not penalised."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([l2 * max(1, len(x)) ** 0.5] * x.shape[1] + [1e-6])
    w = np.zeros(xb.shape[1])
    for _ in range(steps):
        p = sigmoid(xb @ w)
        g = xb.T @ (p - y) + penalty @ w
        h = (xb * (p * (1 - p) + 1e-9)[:, None]).T @ xb + penalty
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])
