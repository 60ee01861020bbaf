"""Model keys run at the size of their operators."""

import json

import pytest

from smogline import config
from smogline.catalog import registry_ml
from smogline.plans import forecast
from smogline.sources import fixtures


class Called(Exception):
    pass


def calls(monkeypatch, name, query):
    """Arguments with which ``query`` first calls a function of ``forecast``."""
    def stop(*args, **params):
        raise Called(args, params)

    monkeypatch.setattr(registry_ml, "features_ckpt", lambda *a: None)
    monkeypatch.setattr(registry_ml, "_ranked", lambda *a: type("R", (), {"collect": lambda self: []})())
    monkeypatch.setattr(forecast, name, stop)
    with pytest.raises(Called) as e:
        query(None, None)
    return e.value.args


def test_full_settings(spark, monkeypatch):
    cut = {"maxIter", "maxDepth", "numTrees"}
    (_, families), _ = calls(monkeypatch, "model_comparison", registry_ml.q_model_comparison)
    assert all(not cut & set(p) for p in families.values())
    assert not cut & set(calls(monkeypatch, "cross_validate", registry_ml.q_categorical_native)[1])
    assert forecast.make_regressor("gbt").getMaxIter() == config.GBT_PARAMS["maxIter"]


def test_sampled_points():
    points = forecast.sample_params(config.SEARCH_TRIALS)
    assert points == forecast.sample_params(config.SEARCH_TRIALS) and len({p["stepSize"] for p in points}) == config.SEARCH_TRIALS
    for p in points:
        assert p.keys() == config.SEARCH_RANGES.keys() and all(config.SEARCH_RANGES[k][0] <= v <= config.SEARCH_RANGES[k][1] for k, v in p.items())


@pytest.mark.parametrize("trials, rounds, plan", [(18, 30, [(18, 3), (6, 10), (2, 30)]), (1, 7, [(1, 7)]), (100, 5, [(100, 1), (33, 1), (11, 5)]), (0, 9, [])])
def test_halving_plan(trials, rounds, plan):
    assert forecast.halving_plan(trials, rounds) == plan


@pytest.fixture(scope="module")
def features(spark):
    return registry_ml.full(spark, "/root/testdata/sf0.001", "eval").checkpoint()


def test_feature_sweep_runs(features):
    ranked = ["lag_1", "city", "lag_3", "pressure", "week_std", "temp_max"]
    table = forecast.FoldTable(features, ranked)
    got = {r["nb_features"]: r for r in forecast.topk_sweep(features, ranked, stop_days=0, maxIter=3).collect()}
    assert sorted(got) == [4, 5, 6] and {r["mean_rounds"] for r in got.values()} == {3.0}
    alone = forecast.cross_validate(features, ranked[:5], "gbt", maxIter=3).agg({"rmse": "avg"}).first()[0]
    assert abs(got[5]["score"] - alone) < 0.05  # the same trees but for the numbering of city slots
    # the slice of a prefix holds its features, and the city's slots only if it has the city
    assert len(table.slots(["lag_1", "lag_3"])) == 2 and len(table.slots(ranked)) == table.size
    stopped = forecast.topk_sweep(features, ranked, kmin=6, stop_days=10, maxIter=6).first()
    assert 1 <= stopped["mean_rounds"] <= 6


def test_search_halves(features):
    points = forecast.sample_params(6)
    got = forecast.param_search(features, ["lag_1", "city", "lag_2"], points, rounds=4, keep=2).collect()
    assert sorted((r["rung"], r["rounds"]) for r in got) == [(1, 1)] * 3 + [(2, 2)] * 2 + [(3, 4)]
    assert len({r["params"] for r in got}) == 6 and [r["rung"] for r in got] == sorted((r["rung"] for r in got), reverse=True)
    # those that went on were the best of their rung; a fit with the last rung's rounds gives the reported score
    best = json.loads(got[0]["params"])
    again = [forecast.FoldTable(features, ["lag_1", "city", "lag_2"])]
    scores = [again[0].score(f, ["lag_1", "city", "lag_2"], **{**best, "maxIter": 4})[0] for f in again[0].folds]
    assert abs(sum(scores) / len(scores) - got[0]["score"]) < 1e-9


def test_no_folds_no_rows(features):
    none = features.where("false")
    assert forecast.topk_sweep(none, ["lag_1", "lag_2", "lag_3", "city"]).count() == 0
    assert forecast.param_search(none, ["lag_1"], forecast.sample_params(2)).count() == 0


def test_sweep_reads_the_big_tables_once(spark, monkeypatch):
    """Features and schedule come from one stored copy of the sensor days; the training rows are the same."""
    sf, reads, real = "/root/testdata/sf0.01", [], fixtures.readings
    feats, lo = registry_ml.features_ckpt(spark, sf), registry_ml._reference_window(spark, sf)[0]
    monkeypatch.setattr(fixtures, "readings", lambda *a: reads.append(a) or real(*a))

    def stop(*args, **params):
        raise Called(args)

    monkeypatch.setattr(forecast, "train_model", stop)
    with pytest.raises(Called) as e:
        registry_ml.q_topk_sweep(spark, sf)
    assert len(reads) == 1
    rows = lambda df: sorted((r.city, r.date, round(r.target, 9), round(r.lag_7, 9)) for r in df.collect())
    assert rows(e.value.args[0][0]) == rows(feats.filter(feats.date < lo)) != []
