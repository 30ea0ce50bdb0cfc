"""A small logistic regression for features of a bounded sample."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40, prior: np.ndarray | None = None) -> np.ndarray:
    """Weights (intercept first) by Newton steps; `ridge` holds the weights at their `prior` (zero), not the intercept.

    Without rows the weights are the prior; with one class the ridge keeps the intercept finite.
    """
    x = np.column_stack([np.ones(len(x)), x]).astype(float)
    start = np.zeros(x.shape[1])
    if prior is not None:
        start[1:] = prior
    w = start.copy()
    hold = np.full(x.shape[1], ridge)
    hold[0] = 1e-2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * (w - start))
        w = w + step * min(1.0, 4 / max(4e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Probabilities of class 1."""
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
