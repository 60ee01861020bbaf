from pyspark.sql import functions as F

from smogline import config
from smogline.plans import events, flows, monitoring
from smogline.plans import preprocess as pp
from smogline.session import scratch_path
from smogline.sources import fixtures, storage

from .conftest import SF01


def test_bootstrap_and_periodic_steps(spark):
    r, w = fixtures.readings(spark, SF01), fixtures.weather(spark, SF01)
    ev = pp.features_table(r, w, mode="eval").checkpoint(eager=True)
    tr = pp.features_table(r, w, mode="train").checkpoint(eager=True)
    sched = monitoring.batch_schedule(ev.select("date")).checkpoint(eager=True)
    first = sched.filter("batch = 1").first()
    ref_lo = first.batch_start.toordinal() - config.BATCH_DAYS
    import datetime as dt

    lo = dt.date.fromordinal(ref_lo)
    ws = flows.Workspace(scratch_path(spark, "t-flows"))
    feats = list(config.SELECTED_FEATURES)
    v = flows.bootstrap_train(spark, ws, tr.filter(F.col("date") < F.lit(lo)), feats, "ridge")
    assert v == "1"
    ref = flows.bootstrap_eval(spark, ws, ev.filter(F.col("date").between(lo, first.train_end)))
    assert ref > 0
    for b in (1, 2):
        out = flows.periodic_step(spark, ws, ev, tr, sched, b, feats, "ridge")
        assert out["drift"] == (out["champion_rmse"] >= ref * 1.1) or out["batch"] > 1
    # replaying a batch is idempotent: nothing is retrained or registered again
    n_models = storage.read_table(spark, ws.models).count()
    again = flows.periodic_step(spark, ws, ev, tr, sched, 2, feats, "ridge")
    assert again.get("replayed") is True
    assert storage.read_table(spark, ws.models).count() == n_models
    batches = storage.read_table(spark, ws.batches)
    assert batches.count() == 2
    models = storage.read_table(spark, ws.models)
    assert models.filter("alias = 'champion'").count() == 1
    preds = storage.read_table(spark, ws.predictions)
    # of each batch the days whose next day is in it
    both = [sched.filter(F.col("batch") == b).first() for b in (1, 2)]
    assert preds.count() == sum(ev.filter((F.col("date") >= b.batch_start) & (F.col("date") < b.batch_end)).count() for b in both)
    assert flows.next_batch(spark, ws, sched) == 3
    # the event log folds into both tables, also when a batch was run again
    log = lambda: events.read(spark, ws.events)
    assert events.agrees(events.fold_models(log()), models) and events.agrees(events.fold_batches(log()), batches)
    flows.periodic_step(spark, ws, ev, tr, sched, 2, feats, "ridge", force=True)
    assert events.agrees(events.fold_batches(log()), storage.read_table(spark, ws.batches))
    assert events.agrees(events.fold_models(log()), storage.read_table(spark, ws.models))


def test_flows_build_each_window_from_its_own_days(spark):
    import datetime as dt

    import pytest

    r, w = fixtures.readings(spark, SF01).checkpoint(), fixtures.weather(spark, SF01).checkpoint()
    between = lambda df: lambda s, e: df.filter(F.col("date").between(F.lit(s), F.lit(e)))
    sources = flows.Sources(between(r), between(w))
    sched = monitoring.batch_schedule(w.select("date")).checkpoint()
    one = sched.filter("batch = 1").first()
    lo, day = one.batch_start - dt.timedelta(config.BATCH_DAYS), dt.timedelta(1)
    ws, feats = flows.Workspace(scratch_path(spark, "t-flows")), list(config.SELECTED_FEATURES)
    assert flows.bootstrap_train_flow(spark, ws, sources, one.train_start, lo - day, feats, "ridge") == "1"
    # the last training day has no next day in its window, so no target
    assert storage.read_table(spark, ws.models).first().train_end == lo - 2 * day
    with pytest.raises(ValueError):
        flows.bootstrap_eval(spark, ws, w, mode="other")
    assert flows.bootstrap_eval_flow(spark, ws, sources, lo, one.train_end) > 0
    assert not flows.ingest_window(spark, ws, sources, lo, one.train_end)  # held already
    assert flows.ingest_window(spark, ws, sources, lo, one.train_end, force=True)
    assert storage.read_table(spark, ws.raw("weather")).count() == w.filter(F.col("date") <= F.lit(one.train_end)).count()
    out = flows.periodic_flow(spark, ws, sources, sched, 1, feats, "ridge")
    assert flows.periodic_flow(spark, ws, sources, sched, 1, feats, "ridge")["champion_rmse"] == out["champion_rmse"]
    logged = storage.read_table(spark, ws.predictions)
    assert logged.agg(F.max("date")).first()[0] == one.batch_end - day
    days = {x.n for x in logged.groupBy("city").agg(F.countDistinct("date").alias("n")).collect()}
    assert max(days) == config.BATCH_DAYS - 1
    assert storage.read_table(spark, ws.models).filter("alias = 'champion'").count() == 1


def test_trees_take_more_cities_than_default_bins(spark):
    import datetime as dt

    from smogline.plans import forecast

    rows = [(f"c{i}", dt.date(2024, 1, 1) + dt.timedelta(j), float(i % 7), float(i + j)) for i in range(50) for j in range(4)]
    df = spark.createDataFrame(rows, "city string, date date, lag_1 double, target double")
    model, _ = forecast.train_model(df, ["city", "lag_1"], "gbt", categorical_native=True, maxIter=1)
    assert model.transform(df).count() == 200


def test_fold_follows_promotions(spark):
    """Two challengers, of which the second is promoted; then one more that is not."""
    import datetime as dt

    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    path = scratch_path(spark, "t-events")
    w = lambda k: (day(42 * k), day(42 * k + 41))
    past = (day(-99), day(-1))
    e = events.event
    steps = [
        [e("registered", "1", train=past)],
        [e("evaluated", "1", 0.5, window=(day(-42), day(-1)))],
        [e("scored", "1", 0.52, batch=w(0))],
        [e("scored", "1", 0.6, batch=w(1)), e("drifted", "1", 0.5, batch=w(1)), e("trained", "2", 0.61, past, w(1), w(1))],
        [e("scored", "1", 0.7, batch=w(2)), e("drifted", "1", 0.5, batch=w(2)), e("trained", "3", 0.4, past, w(2), w(2)), e("promoted", "3", 0.4, batch=w(2))],
        [e("scored", "3", 0.9, batch=w(3)), e("drifted", "3", 0.4, batch=w(3)), e("trained", "4", 0.95, past, w(3), w(3))],
    ]
    alias = []
    for step in steps:
        events.append(spark, path, step)
        alias.append({r.model_version: r.alias for r in events.fold_models(events.read(spark, path)).collect()})
    assert alias[2] == {"1": "champion"} and alias[3] == {"1": "champion", "2": "challenger"}
    assert alias[4] == {"1": "archived", "2": "archived", "3": "champion"}
    assert alias[5] == {"1": "archived", "2": "archived", "3": "champion", "4": "challenger"}
    rows = {r.batch_start: r for r in events.fold_batches(events.read(spark, path)).collect()}
    assert [(rows[w(k)[0]].drift_detected, rows[w(k)[0]].challenger_version, rows[w(k)[0]].promotion_applied) for k in range(4)] == [
        (False, None, None), (True, "2", False), (True, "3", True), (True, "4", False)]
    # the state at an earlier time
    cut = sorted(r[0] for r in events.read(spark, path).select("at").distinct().collect())[3]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    past_state = events.read(spark, path).where(F.col("at") <= F.lit(cut))
    assert {r.model_version: r.alias for r in events.fold_models(past_state).collect()} == alias[3]
