"""Small models fitted on the driver from bounded samples."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Logistic(NamedTuple):
    """P(label = 1) of a feature row."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the intercept is last

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        z = np.column_stack([(rows - self.mean) / self.scale, np.ones(len(rows))]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> Logistic:
    """Ridge-penalised logistic regression by Newton steps, halved until they improve."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.column_stack([(rows - mean) / scale, np.ones(len(rows))])
    sign = 2.0 * labels - 1
    penalty = np.diag([ridge] * rows.shape[1] + [1e-6])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, -sign * (x @ w)).sum() + w @ penalty @ w / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-4:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Logistic(mean, scale, w)


class Tree(NamedTuple):
    """A binary decision tree: a leaf has ``feature`` None."""
    feature: int | None
    threshold: float
    share: float  # of label 1
    low: "Tree | None" = None
    high: "Tree | None" = None

    def __call__(self, row) -> float:
        node = self
        while node.feature is not None:
            node = node.low if row[node.feature] <= node.threshold else node.high
        return node.share


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 1) -> Tree:
    """Decision tree by largest decrease of Gini impurity; ties go to the first feature."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return Tree(None, 0.0, share)
    best = (share * (1 - share) * len(labels) - 1e-12, None, 0.0)
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = rows[:, f] <= cut
            parts = labels[left], labels[~left]
            if min(map(len, parts)) >= least:
                impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in parts)
                if impurity < best[0]:
                    best = (impurity, f, float(cut))
    if best[1] is None:
        return Tree(None, 0.0, share)
    left = rows[:, best[1]] <= best[2]
    return Tree(best[1], best[2], share, fit_tree(rows[left], labels[left], depth - 1, least),
                fit_tree(rows[~left], labels[~left], depth - 1, least))
