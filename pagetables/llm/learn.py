"""Logistic regression on small dense arrays, as the fitted parts of several operators need it."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(z, -60, 60)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method; the last coefficient is the intercept, which is not penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def predict_logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def area_under_roc(scores: np.ndarray, labels: np.ndarray) -> float:
    order = np.argsort(scores, kind="stable")
    values, start, counts = np.unique(scores[order], return_index=True, return_counts=True)
    ranks = np.repeat(start + (counts + 1) / 2, counts)
    positive = labels[order] == 1
    n, m = positive.sum(), (~positive).sum()
    return float((ranks[positive].sum() - n * (n + 1) / 2) / (n * m)) if n and m else float("nan")
