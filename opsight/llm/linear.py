"""Logistic regression on sparse rows of a bounded sample, with a penalty on paired rows and Platt calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows as (row, column, value) triples."""

    rows: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    n_rows: int
    n_cols: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.vals * w[self.cols], self.n_rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, self.vals * r[self.rows], self.n_cols)

    def take(self, keep: np.ndarray) -> Sparse:
        """The rows marked in `keep`, renumbered."""
        on = keep[self.rows]
        number = np.cumsum(keep) - 1
        return Sparse(number[self.rows[on]], self.cols[on], self.vals[on], int(keep.sum()), self.n_cols)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse, y: np.ndarray, l2: float, steps: int = 200, rate: float = 0.1,
        pairs: Sparse | None = None, pair_weight: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over the whole sample: log loss + l2 |w|^2 / 2 + pair_weight * mean (d.w)^2.

    A row d of `pairs` is the difference of a row and its counterfactual. The result is the same on every run.
    """
    w, b = np.zeros(x.n_cols), 0.0
    if x.n_rows == 0:
        return w, b
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b = float(np.log(share / (1 - share)))
    m, v = np.zeros(x.n_cols + 1), np.zeros(x.n_cols + 1)
    for step in range(1, steps + 1):
        r = (sigmoid(x.dot(w) + b) - y) / x.n_rows
        g = x.back(r) + l2 * w
        if pairs is not None and pairs.n_rows and pair_weight:
            g += 2 * pair_weight * pairs.back(pairs.dot(w)) / pairs.n_rows
        g = np.append(g, r.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make sigmoid(slope * z + shift) a probability (Newton steps, smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not len(y) or not pos or not neg:
        return 1.0, 0.0
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    centre, spread = float(z.mean()), float(z.std()) or 1.0
    u = (z - centre) / spread

    def loss(v: np.ndarray) -> float:
        t = v[0] * u + v[1]
        return float((np.logaddexp(0, t) - goal * t).sum() + 1e-3 * (v @ v))

    at = np.array([1.0, np.log(pos / neg)])
    for _ in range(60):
        p = sigmoid(at[0] * u + at[1])
        s = p * (1 - p)
        g = np.array([((p - goal) * u).sum(), (p - goal).sum()]) + 2e-3 * at
        h = np.array([[(s * u * u).sum(), (s * u).sum()], [(s * u).sum(), s.sum()]]) + 2e-3 * np.eye(2)
        move, now = np.linalg.solve(h, g), loss(at)
        while loss(at - move) > now and np.abs(move).max() > 1e-9:
            move = move / 2
        at = at - move
    slope = max(at[0], 1e-3) / spread
    return float(slope), float(at[1] - slope * centre)
