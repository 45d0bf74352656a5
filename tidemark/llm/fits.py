"""Ridge logistic regression by damped Newton steps."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, weight: np.ndarray | None = None, steps: int = 60) -> np.ndarray:
    """Weights of rows ``x`` for labels ``y`` between 0 and 1; ``ridge`` is the penalty of each weight.

    A step is halved until it lowers the loss, so nearly separable classes don't make it diverge."""
    weight = np.ones(len(x)) if weight is None else weight
    total = weight.sum()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() / total + 0.5 * (ridge * w * w).sum())

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (weight * (y - p)) / total - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x / total + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        while (then := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if now - then < 1e-12:
            break
        w, now = w + step, then
    return w
