"""Linear model families from fold-wise Gram matrices.

One aggregation over the rows gives, for every (date segment, city), the sums
of products of the numeric features and the label.  Segments are cut at the
folds' bounds, so a fold's training and test matrices are sums of segments: an
expanding fold is a running sum.  The city's one-hot slots need no product of
their own; their rows of the matrix are the per-city sums.  What comes to the
driver is (segments x cities) rows of p (p + 3) / 2 numbers, however many rows
the table has; fits, regularisation paths and feature prefixes are solved there
without reading the table again, and test errors follow from the test matrix.

Rows with a null feature or label are left out.  Features are standardised with
the training rows' mean and population deviation; a constant one gets no weight.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Gram:
    """Sums of products of the columns [1, numeric features..., city slots..., label]."""

    columns: list[str]
    sums: np.ndarray

    @property
    def n(self) -> float:
        return self.sums[0, 0]

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.columns, self.sums + other.sums)

    def keep(self, features: list[str]) -> Gram:
        """The same rows, only these features (``city`` stands for all its slots)."""
        use = [i for i, c in enumerate(self.columns) if c in ("1", "label") or c in features or (c.startswith("city=") and "city" in features)]
        return Gram([self.columns[i] for i in use], self.sums[np.ix_(use, use)])


def gram_segments(df: DataFrame, features: list[str], starts: list[dt.date], label: str = "target") -> list[Gram]:
    """Gram matrices of the date segments [.., s1), [s1, s2), ..., [sk, ..), in one job."""
    numeric = [f for f in features if f != "city"]
    with_city = "city" in features
    x = [F.col(f).cast("double") for f in numeric] + [F.col(label).cast("double")]
    segment = sum([(F.col("date") >= F.lit(s)).cast("int") for s in starts], F.lit(0))
    keys = [segment.alias("_seg"), (F.col("city") if with_city else F.lit("")).alias("_city")]
    rows = df.select(*keys, *[c.alias(f"_x{i}") for i, c in enumerate(x)]).dropna()
    p = len(x)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(f"_x{i}").alias(f"s{i}") for i in range(p)] + [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"s{i}_{j}") for i, j in pairs]
    found = rows.groupBy("_seg", "_city").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    cities = sorted({r["_city"] for r in found}) if with_city else []
    columns = ["1", *numeric, *[f"city={c}" for c in cities], "label"]
    place = [1 + i for i in range(p - 1)] + [len(columns) - 1]  # of _x0, _x1, ... in the columns
    slot = {c: p + k for k, c in enumerate(cities)}
    out = [Gram(columns, np.zeros((len(columns), len(columns)))) for _ in range(len(starts) + 1)]
    for r in sorted(found, key=lambda r: (r["_seg"], r["_city"])):
        m = np.zeros((len(columns), len(columns)))
        for i, j in pairs:
            m[place[i], place[j]] = m[place[j], place[i]] = r[f"s{i}_{j}"]
        ones = [0] + ([slot[r["_city"]]] if with_city else [])
        for a in ones:
            for i in range(p):
                m[a, place[i]] = m[place[i], a] = r[f"s{i}"]
            for b in ones:
                m[a, b] = r["n"]
        out[r["_seg"]].sums += m
    return out


def fold_grams(df: DataFrame, features: list[str], folds: DataFrame) -> dict[int, tuple[Gram, Gram]]:
    """fold -> (training, test) matrices, from one pass over the rows."""
    bounds = {(int(r["fold"]), r["role"]): (r["start"], r["end"]) for r in folds.collect()}  # 2 rows per fold
    day = dt.timedelta(days=1)
    starts = sorted({d for lo, hi in bounds.values() for d in (lo, hi + day)})
    segments = gram_segments(df, features, starts)
    at = {d: i + 1 for i, d in enumerate(starts)}
    empty = Gram(segments[0].columns, np.zeros_like(segments[0].sums))
    whole = {key: sum(segments[at[lo] : at[hi + day]], empty) for key, (lo, hi) in bounds.items()}
    return {f: (whole[f, "train"], whole[f, "test"]) for f, role in sorted(whole) if role == "test" and (f, "train") in whole}


def solve(train: Gram, l1: float, l2: float, tolerance: float = 1e-13, sweeps: int = 100_000) -> np.ndarray:
    """Weights [intercept, features...] of  |y - Zb|^2 / 2n + l1 |b|_1 + l2 |b|^2 / 2  on standardised
    features: the normal equations if ``l1`` is 0, else cyclic coordinate descent on the matrix."""
    n, s = train.n, train.sums
    if not n:
        raise ValueError("no training rows")
    mean = s[0, 1:] / n
    cov = s[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
    flat = scale <= 1e-7 * np.maximum(np.abs(mean[:-1]), 1e-300)
    scale = np.where(flat, 1.0, scale)
    a = cov[:-1, :-1] / np.outer(scale, scale)
    b = cov[:-1, -1] / scale
    a[flat, :] = a[:, flat] = b[flat] = 0.0
    w = np.zeros(len(b))
    use = np.flatnonzero(~flat)
    if l1 == 0:
        w[use] = np.linalg.lstsq(a[np.ix_(use, use)] + l2 * np.eye(len(use)), b[use], rcond=None)[0]
    else:
        left = b - a @ w
        for _ in range(sweeps):
            moved = 0.0
            for j in use:
                rho = left[j] + a[j, j] * w[j]
                new = math.copysign(max(abs(rho) - l1, 0.0), rho) / (a[j, j] + l2)
                if new != w[j]:
                    left -= a[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]))
                    w[j] = new
            if moved < tolerance:
                break
    w = w / scale
    return np.concatenate([[mean[-1] - mean[:-1] @ w], w])


def rmse(weights: np.ndarray, test: Gram) -> float | None:
    """Root mean squared error on the rows behind ``test``; no rows: null."""
    v = np.concatenate([weights, [-1.0]])
    return math.sqrt(max(v @ test.sums @ v, 0.0) / test.n) if test.n else None


#: penalties (l1, l2): elastic net with equal shares of 0.01, ridge of 0.01
FAMILIES = {"elastic": (0.005, 0.005), "ridge": (0.0, 0.01)}


def linear_scores(grams: dict[int, tuple[Gram, Gram]], families: dict[str, tuple[float, float]] = FAMILIES) -> list[tuple[str, int, float | None]]:
    """(model, fold, rmse) of every family on every fold."""
    return [(name, f, rmse(solve(train, *penalty), test)) for name, penalty in families.items() for f, (train, test) in grams.items()]


def linear_crossval(df: DataFrame, features: list[str], folds: DataFrame, families: dict[str, tuple[float, float]] = FAMILIES) -> DataFrame:
    """Fold scores of linear families: (model, fold, rmse), one job for all of them."""
    return df.sparkSession.createDataFrame(linear_scores(fold_grams(df, features, folds), families), "model string, fold long, rmse double")


def linear_topk(df: DataFrame, ranked: list[str], folds: DataFrame, kmin: int = 4, penalty: tuple[float, float] = FAMILIES["ridge"]) -> DataFrame:
    """Fold scores of growing feature prefixes: (nb_features, score, std_score).  Each
    prefix is a sub-matrix, so the whole sweep reads the rows once."""
    grams = fold_grams(df, ranked, folds)
    out = []
    for k in range(kmin, len(ranked) + 1):
        scores = [rmse(solve(train.keep(ranked[:k]), *penalty), test.keep(ranked[:k])) for train, test in grams.values()]
        if scores:
            out.append((k, float(np.mean(scores)), float(np.std(scores))))
    return df.sparkSession.createDataFrame(out, "nb_features long, score double, std_score double")


__all__ = ["FAMILIES", "Gram", "fold_grams", "gram_segments", "linear_crossval", "linear_scores", "linear_topk", "rmse", "solve"]
