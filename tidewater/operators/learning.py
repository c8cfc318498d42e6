"""Online k-means and linear regression with the data work on Spark.

Per batch, Spark does one pass over the rows (assignment plus per-cluster
sums, or the regression moments); the driver keeps only the model, a
``k x d`` array of centres or a ``(d+1)`` weight vector, which does not
grow with the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Scaling (mean 0, unit population standard deviation)


def column_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (one Spark
    aggregate; the result is two numbers per column)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, cols: list[str], stats=None, suffix: str = "_std") -> DataFrame:
    """Add ``(x - mean) / stddev`` columns; ``stats`` from ``column_stats``
    (kept by the caller to scale back)."""
    stats = stats or column_stats(df, cols)
    out = df
    for c in cols:
        m, s = stats[c]
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0))
    return out


# ---------------------------------------------------------------------------
# k-means


def squared_distances(features: list[str], centres) -> list[Column]:
    out = []
    for c in centres:
        d = None
        for f, v in zip(features, c):
            t = (F.col(f) - F.lit(float(v))) * (F.col(f) - F.lit(float(v)))
            d = t if d is None else d + t
        out.append(d)
    return out


def nearest_centre(features: list[str], centres) -> Column:
    """Index of the nearest centre (first one on ties), as an int column."""
    d = F.array(*squared_distances(features, centres))
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def cluster_sums(df: DataFrame, features: list[str], centres) -> DataFrame:
    """Per nearest centre: count and per-dimension sums (one aggregate)."""
    a = df.select(nearest_centre(features, centres).alias("cluster"), *features)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.sum(f).alias(f"sum_{f}") for f in features])


@dataclass
class KMeansModel:
    """Centres and weights of a streaming k-means model."""
    centres: np.ndarray
    weights: np.ndarray
    decay: float = 1.0
    split_dying: bool = True
    batches: int = 0

    @classmethod
    def random(cls, k: int, dim: int, weight: float = 0.0, seed: int = 42, decay: float = 1.0):
        rng = np.random.default_rng(seed)
        return cls(rng.standard_normal((k, dim)), np.full(k, float(weight)), decay)

    @classmethod
    def from_centres(cls, centres, weight: float = 0.0, decay: float = 1.0):
        c = np.asarray(centres, dtype=float)
        return cls(c.copy(), np.full(len(c), float(weight)), decay)

    def update(self, sums: list[tuple[int, int, list[float]]]) -> "KMeansModel":
        """Fold one batch's (cluster, count, per-dimension sums) into the model.

        Weights are discounted by the decay, then each centre moves to the
        weighted mean of itself and its new points:
        ``c = (c * w * decay + sum) / (w * decay + n)``.  A cluster whose
        weight falls below 1e-8 of the largest is restarted by splitting the
        largest cluster in two (both halves a hair apart), so no centre
        stays dead.
        """
        self.weights = self.weights * self.decay
        for idx, n, s in sums:
            if n == 0:
                continue
            w = self.weights[idx] + n
            lam = n / max(w, 1e-16)
            self.centres[idx] = (1.0 - lam) * self.centres[idx] + (lam / n) * np.asarray(s, dtype=float)
            self.weights[idx] = w
        if self.split_dying and len(self.weights) > 1:
            big, small = int(np.argmax(self.weights)), int(np.argmin(self.weights))
            if self.weights[small] < 1e-8 * self.weights[big]:
                w = (self.weights[big] + self.weights[small]) / 2.0
                self.weights[big] = self.weights[small] = w
                x = self.centres[big].copy()
                p = 1e-14 * np.maximum(np.abs(x), 1.0)
                self.centres[big] = x + p
                self.centres[small] = x - p
        self.batches += 1
        return self

    def train_batch(self, df: DataFrame, features: list[str]) -> "KMeansModel":
        rows = cluster_sums(df, features, self.centres.tolist()).collect()  # <= k rows
        return self.update([(r["cluster"], r["n"], [r[f"sum_{f}"] for f in features]) for r in rows])

    def to_rows(self) -> list[tuple]:
        return [(i, float(self.weights[i]), [float(v) for v in self.centres[i]])
                for i in range(len(self.centres))]


# ---------------------------------------------------------------------------
# Linear regression by gradient descent on per-batch moments


def regression_moments(df: DataFrame, x_cols: list[str], y: str) -> DataFrame:
    """n, sums of x, y, x_i*x_j and x_i*y: all a least-squares gradient
    needs, in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(F.col(y) * F.col(y)).alias("syy")]
    for i, a in enumerate(x_cols):
        aggs += [F.sum(a).alias(f"sx{i}"), F.sum(F.col(a) * F.col(y)).alias(f"sxy{i}")]
        for j, b in enumerate(x_cols):
            if j >= i:
                aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"sxx{i}{j}"))
    return df.agg(*aggs)


@dataclass
class LinearModel:
    """Streaming linear regression fitted by gradient descent.

    Each batch runs ``iterations`` full-batch steps of size
    ``step / sqrt(t)`` on the mean squared-error gradient, stopping early
    when the weights move less than ``tolerance`` (relative).  The
    gradient of a batch is computed from its moments, so the batch is read
    once however many steps are taken.  ``restart_intercept`` starts each
    batch's intercept at 1.0 instead of carrying it over.
    """
    weights: np.ndarray
    intercept: float = 0.0
    step: float = 0.1
    iterations: int = 50
    tolerance: float = 0.001
    fit_intercept: bool = True
    restart_intercept: bool = False
    batches: int = 0
    history: list = field(default_factory=list)

    @classmethod
    def zeros(cls, d: int, **kw):
        return cls(np.zeros(d), **kw)

    def update_from_moments(self, m: dict, d: int) -> "LinearModel":
        n = m["n"] or 0
        if n == 0:
            return self
        # Augmented design [x, 1]: A = E[x' x'^T], b = E[y x'].
        size = d + 1 if self.fit_intercept else d
        A = np.zeros((size, size))
        b = np.zeros(size)
        for i in range(d):
            b[i] = m[f"sxy{i}"] / n
            for j in range(d):
                A[i, j] = m[f"sxx{min(i, j)}{max(i, j)}"] / n
        if self.fit_intercept:
            for i in range(d):
                A[i, d] = A[d, i] = m[f"sx{i}"] / n
            A[d, d] = 1.0
            b[d] = m["sy"] / n
        w = np.append(self.weights, 1.0 if self.restart_intercept else self.intercept) \
            if self.fit_intercept else self.weights.copy()
        for t in range(1, self.iterations + 1):
            grad = A @ w - b
            new = w - (self.step / math.sqrt(t)) * grad
            moved = np.linalg.norm(new - w)
            w = new
            if moved < self.tolerance * max(np.linalg.norm(w), 1.0):
                break
        if self.fit_intercept:
            self.weights, self.intercept = w[:d], float(w[d])
        else:
            self.weights = w
        self.batches += 1
        return self

    def train_batch(self, df: DataFrame, x_cols: list[str], y: str) -> "LinearModel":
        row = regression_moments(df, x_cols, y).first()
        return self.update_from_moments(row.asDict(), len(x_cols))

    def predict(self, x_cols: list[str]) -> Column:
        e = F.lit(float(self.intercept))
        for c, w in zip(x_cols, self.weights):
            e = e + F.col(c) * F.lit(float(w))
        return e


def least_squares(m: dict) -> tuple[float, float]:
    """Closed-form slope and intercept of one feature from its moments."""
    n, sx, sy, sxx, sxy = m["n"], m["sx0"], m["sy"], m["sxx00"], m["sxy0"]
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return slope, (sy - slope * sx) / n
