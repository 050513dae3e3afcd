"""Small numpy models fitted on a bounded sample of labelled rows, and how that sample is drawn."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000  # labelled rows a model is fitted on, chosen by the hash of their id; all rows are scored


def fold(id_col: Column, parts: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, id_col: str, text_col: str, limit: int = MAX_LABELLED
) -> DataFrame:
    """``(id, text, y)`` of at most ``limit`` labelled ids outside the held-out fold, one text each.

    Ids with more than one label count with the largest; null ids and labels are left out. Ids are drawn by their hash from those that ``docs`` has. Of
    several texts of one id the one with the smallest hash stands for it, so an id that many rows share is one row here and ``limit`` holds. The sample of
    labels is narrow, so it is broadcast; a task keeps one text per id before anything moves.
    """
    known = labels.where(~held_out & F.col(label).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("double").alias("y"))
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id")
    order = F.struct(F.xxhash64("text"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return texts.groupBy("id").agg(F.min_by(F.struct("text"), order).alias("t"), F.max("y").alias("y")).select("id", "t.text", "y")


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Weights with the intercept last, by Newton's method; the base rate if there is only one class."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 1) / (len(y) + 2)
    w[-1] = np.log(rate / (1 - rate))
    if len(np.unique(y)) < 2:
        return w
    penalty = np.full(x.shape[1], l2 * len(y) / 100)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Network:
    """Two layers: standardised input, ReLU units, one logit, divided by a temperature fitted on a part kept back."""

    def __init__(self, hidden: int = 32, epochs: int = 30, batch: int = 128, rate: float = 3e-3, l2: float = 1e-4, seed: int = 7):
        self.hidden, self.epochs, self.batch, self.rate, self.l2, self.seed = hidden, epochs, batch, rate, l2, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        """Rows must come in a fixed order; every tenth is kept back for the temperature."""
        n, d = x.shape
        self.mean, self.scale = (x.mean(0), x.std(0) + 1e-6) if n else (np.zeros(d), np.ones(d))
        rng = np.random.default_rng(self.seed)
        self.w1 = rng.normal(0, np.sqrt(2 / max(1, d)), (d, self.hidden))
        self.b1, self.w2 = np.zeros(self.hidden), rng.normal(0, np.sqrt(1 / self.hidden), self.hidden)
        rate = (y.sum() + 1) / (n + 2)
        self.b2, self.temperature = np.array([np.log(rate / (1 - rate))]), 1.0
        if len(np.unique(y)) < 2:
            self.w2[:] = 0
            return self
        kept_back = np.arange(n) % 10 == 9 if n >= 100 else np.zeros(n, bool)
        xs, ys = (x[~kept_back] - self.mean) / self.scale, y[~kept_back]
        params = [self.w1, self.b1, self.w2, self.b2]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(self.epochs):
            order = rng.permutation(len(xs))
            for at in range(0, len(order), self.batch):
                rows = order[at : at + self.batch]
                h = np.maximum(xs[rows] @ self.w1 + self.b1, 0)
                error = (sigmoid(h @ self.w2 + self.b2) - ys[rows]) / len(rows)
                back = np.outer(error, self.w2) * (h > 0)
                grads = [xs[rows].T @ back + self.l2 * self.w1, back.sum(0), h.T @ error + self.l2 * self.w2, error.sum(keepdims=True)]
                t += 1
                for i, (p, g) in enumerate(zip(params, grads)):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p -= self.rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        if kept_back.any() and len(np.unique(y[kept_back])) == 2:
            z, target = self.logits(x[kept_back]), y[kept_back]
            grid = np.exp(np.linspace(np.log(0.5), np.log(10), 60))
            loss = [np.logaddexp(0, z / g).mean() - (target * z / g).mean() for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)
