"""A linear support vector machine for small dense samples, fitted on the driver."""

from __future__ import annotations

import numpy as np


def fit_svm(x: np.ndarray, positive: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L2-regularised squared hinge loss, by accelerated gradient steps.

    Rows are balanced between the classes.  The step is 1 / L for rows of length at most one.
    """
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, ahead, rate = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), np.float32(1 / (4 + penalty))
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - rate * (penalty * ahead - 2 * (share * y * slack) @ x)
        ahead = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w[:-1].copy(), float(w[-1])
