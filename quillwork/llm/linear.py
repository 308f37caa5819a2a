"""Sparse logistic regression on the driver, over a bounded sample of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows: columns and values of row i lie at ends[i-1]:ends[i]."""

    ends: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        if not rows:
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return cls(np.cumsum([len(c) for c, _ in rows]), np.concatenate([c for c, _ in rows]).astype(np.int64), np.concatenate([v for _, v in rows]).astype(np.float64))

    def __len__(self) -> int:
        return len(self.ends)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Rows, y: np.ndarray, width: int, l2: float = 1e-3, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression by accelerated gradient steps. With one class only, the bias is its log-odds."""
    n, rate = len(y), np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    bias = float(np.log(rate / (1 - rate)))
    w = np.zeros(width)
    if n == 0 or y.min() == y.max():
        return w, bias
    at = x.row_of()
    share = 1.0 / n
    # a step of 1/L, where L bounds the curvature by the largest squared norm of a row
    norms = np.bincount(at, x.values**2, n)
    step = 1.0 / (0.25 * (norms.mean() * 4 + 1) + l2)
    look, look_b, t = w.copy(), bias, 1.0
    for _ in range(steps):
        z = np.bincount(at, look[x.columns] * x.values, n) + look_b
        off = (sigmoid(z) - y) * share
        grad = np.bincount(x.columns, off[at] * x.values, width) + l2 * look
        new, new_b = look - step * grad, look_b - step * off.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - bias)
        w, bias, t = new, new_b, t_new
    return w, float(bias)


def platt(z: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift that calibrate scores z by Newton steps; slope stays positive. (1, 0) where there is nothing to learn from."""
    if len(y) < 20 or y.min() == y.max():
        return 1.0, 0.0
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta, design = np.array([1.0, 0.0]), np.stack([z, np.ones_like(z)], 1)
    for _ in range(steps):
        p = sigmoid(design @ theta)
        hess = design.T @ (design * (p * (1 - p) + 1e-9)[:, None]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, design.T @ (p - target))
        theta = theta - np.clip(move, -2, 2)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)
