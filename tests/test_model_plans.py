"""Linear families from Gram matrices, and the exact permutation test."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.plans import forecast, gram

D0 = dt.date(2024, 1, 1)
FEATURES = ["a", "city", "b", "flat", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(120):
        for city in ("A", "B", "C")[: 2 if i < 40 else 3]:  # C is unseen in the first days
            a, b, c = rng.normal(5, 2), rng.normal(1000, 10), rng.uniform(0, 1)
            y = 0.5 * a - 0.02 * b + {"A": 0.0, "B": 1.0, "C": -1.0}[city] + rng.normal(0, 0.1)
            out.append((city, D0 + dt.timedelta(days=i), float(a), float(b), 7.0, float(c), float(y)))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([*rows, ("A", D0, None, 1.0, 7.0, 1.0, 1.0)], "city string, date date, a double, b double, flat double, c double, target double")


def matrix(rows, cities):
    x = np.array([[r[2], r[3], r[4], r[5], *[float(r[0] == c) for c in cities]] for r in rows])
    return x, np.array([r[6] for r in rows])


def spans(folds):
    return {(r["fold"], r["role"]): (r["start"], r["end"]) for r in folds.collect()}


def test_fold_scores_equal_fits_on_the_rows(frame, rows):
    folds = forecast.time_folds(frame, n_folds=3, test_days=20, gap_days=5)
    got = {(r["model"], r["fold"]): r["rmse"] for r in gram.linear_crossval(frame, FEATURES, folds).collect()}
    at = spans(folds)
    for f in (1, 2, 3):
        (x, y), (tx, ty) = (matrix([r for r in rows if at[f, role][0] <= r[1] <= at[f, role][1]], "ABC") for role in ("train", "test"))
        mean, sd = x.mean(axis=0), x.std(axis=0)
        use = sd > 1e-9
        z, tz = (x - mean)[:, use] / sd[use], (tx - mean)[:, use] / sd[use]
        w = np.linalg.solve(z.T @ z / len(y) + 0.01 * np.eye(z.shape[1]), z.T @ (y - y.mean()) / len(y))
        assert abs(got["ridge", f] - np.sqrt(np.mean((ty - y.mean() - tz @ w) ** 2))) < 1e-9
    assert set(got) == {(m, f) for m in gram.FAMILIES for f in (1, 2, 3)}


def test_elastic_net_meets_its_optimality_conditions(frame, rows):
    train = sum(gram.gram_segments(frame, FEATURES, [D0 + dt.timedelta(days=50)])[1:], gram.gram_segments(frame, FEATURES, [D0 + dt.timedelta(days=50)])[0])
    x, y = matrix(rows, "ABC")
    assert train.n == len(y) and np.allclose(train.sums[1:-1, -1], x.T @ y)  # the row with a null is left out
    for l1, l2 in ((0.05, 0.01), (0.4, 0.0001)):
        w = gram.solve(train, l1, l2)
        sd = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
        z, b = (x - x.mean(axis=0)) / sd, w[1:] * sd
        pull = z.T @ (y - w[0] - x @ w[1:]) / len(y) - l2 * b
        assert np.all(np.abs(pull[b == 0]) <= l1 + 1e-9) and np.allclose(pull[b != 0], l1 * np.sign(b[b != 0]), atol=1e-9)
        assert (b == 0).any() and (b != 0).any()


def test_prefixes_are_fits_of_their_features(frame):
    folds = forecast.time_folds(frame, n_folds=2, test_days=20, gap_days=5)
    sweep = {r["nb_features"]: r["score"] for r in gram.linear_topk(frame, FEATURES, folds, kmin=2).collect()}
    for k in (2, 5):
        alone = gram.linear_crossval(frame, FEATURES[:k], folds, {"ridge": gram.FAMILIES["ridge"]})
        assert abs(sweep[k] - alone.agg(F.avg("rmse")).first()[0]) < 1e-9
    empty = frame.where("false")
    assert gram.linear_topk(empty, FEATURES, forecast.time_folds(empty)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 17, 100, 1009])
def test_keyed_bijection(spark, n):
    df = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "key"))
    got = df.select("key", forecast.keyed_bijection(F.col("id"), n, F.col("key")).alias("to")).collect()
    for key in range(3):
        assert sorted(r["to"] for r in got if r["key"] == key) == list(range(n))
    if n > 50:
        maps = {key: tuple(r["to"] for r in got if r["key"] == key) for key in range(3)}
        assert len(set(maps.values())) == 3


def test_row_ranks_are_dense_and_ordered(frame, rows):
    got = sorted((r["_rank"], r["date"], r["city"]) for r in forecast.row_ranks(frame.dropna()).collect())
    assert [g[0] for g in got] == list(range(len(rows)))
    assert [g[1:] for g in got] == sorted((r[1], r[0]) for r in rows)


def test_every_copy_permutes_one_feature_of_all_rows(frame, rows):
    features = ["a", "city", "c"]
    copies = forecast.permuted(frame.dropna(), features, repeats=2, seed=9)
    assert "Window" not in copies._jdf.queryExecution().executedPlan().toString()  # ranks are stored, nothing windows the copies
    got = copies.collect()
    place = {"city": 0, "a": 2, "b": 3, "flat": 4, "c": 5, "target": 6}
    moved = 0
    for f, name in enumerate(features):
        for rep in range(2):
            part = [r for r in got if (r["_feature"], r["_rep"]) == (f, rep)]
            assert len(part) == len(rows)
            assert Counter(r[name] for r in part) == Counter(r[place[name]] for r in rows)
            others = [c for c in place if c != name]
            assert Counter(tuple(r[c] for c in others) for r in part) == Counter(tuple(r[place[c]] for c in others) for r in rows)
            before = {tuple(r[place[c]] for c in others): r[place[name]] for r in rows}
            moved += sum(before[tuple(r[c] for c in others)] != r[name] for r in part)
    assert moved > 0.6 * len(got)


def test_importance_finds_the_feature_that_counts(spark):
    rng = random.Random(6)
    rows = [("A", D0 + dt.timedelta(days=i), x := rng.uniform(0, 1), rng.uniform(0, 1), 3 * x) for i in range(300)]
    df = spark.createDataFrame(rows, "city string, date date, a double, b double, target double")
    model, _ = forecast.train_model(df, ["a", "b"], "gbt", maxIter=3)
    imp = {r["feature"]: r["importance_mean"] for r in forecast.permutation_importance(model, df, ["a", "b"]).collect()}
    assert imp["a"] > 0.5 and abs(imp["b"]) < 0.1
