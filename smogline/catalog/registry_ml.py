"""Registered MLlib, flow and streaming queries (rows-only checks: model
fits and streams have no SQL equivalent).

Every model has the library's own settings (``config.GBT_PARAMS``, and the
defaults of ``forecast.make_regressor``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import config
from ..plans import events as loop_log
from ..plans import flows, forecast, gram
from ..plans import preprocess as pp
from ..session import scratch_path
from ..sources import storage
from ..streaming.periodic import stream_periodic
from ..streaming.rollup import stream_daily_rollup, write_arrivals
from .registry import FOLD_CTES, ROLLUP_DOUBLES, SCHED_CTES, events, full, readings, register, schedule, weather
from .sql_prelude import windowed, with_ctes

FEATURES = list(config.SELECTED_FEATURES)


def features_ckpt(spark, d, mode="train"):
    """Feature table written once to the shared checkpoint folder: the many
    model fits that follow read it instead of recomputing the chain, and a
    lost executor re-reads it instead of replaying the lineage."""
    return full(spark, d, mode).checkpoint(eager=True)


def _reference_window(spark, d, evaluated=None):
    """(start, end) of the window before the first batch, resolved once on
    the driver so the many jobs that filter on it do not re-derive it."""
    s = schedule(spark, d, evaluated).filter(F.col("batch") == 1)
    r = s.select(
        F.date_sub("batch_start", config.BATCH_DAYS).alias("lo"), F.date_sub("batch_start", 1).alias("hi")
    ).first()
    return r["lo"], r["hi"]


def _both_modes(spark, d):
    """(stored train-mode features, eval-mode features), both from one stored copy of the
    sensor days and of the weather, so the big tables are read once for the two."""
    days, wx = readings(spark, d).checkpoint(), weather(spark, d).checkpoint()
    return pp.features_table(days, wx, mode="train").checkpoint(eager=True), pp.features_table(days, wx, mode="eval")


def _train(spark, d, feats=None, evaluated=None):
    """Training rows: train-mode features before the reference window."""
    if feats is None:
        feats, evaluated = _both_modes(spark, d)
    lo, _ = _reference_window(spark, d, evaluated)
    return feats.filter(F.col("date") < F.lit(lo))


def _reference_rows(spark, d):
    lo, hi = _reference_window(spark, d)
    return pp.evaluation_slice(features_ckpt(spark, d, "eval"), lo, hi, config.HORIZON)


_SLOTS = ", ".join(f"CAST({f} AS DOUBLE)" for f in FEATURES if f != "city")


@register(
    "split_xy",
    with_ctes(f"""
SELECT CAST(unnest(range(len(v))) AS BIGINT) AS slot, unnest(v) AS value, target AS label
FROM (SELECT f.target, list_concat([{_SLOTS}], list_transform(range((SELECT count(*) FROM city_at)), lambda x: CASE WHEN x = c.at THEN 1.0 ELSE 0.0 END::DOUBLE)) AS v
      FROM full_train f JOIN city_at c USING (city)) t""", "full_train",
              extra={"city_at": "SELECT city, row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS at FROM full_train GROUP BY city"}),
    ["value", "label"],
)
def q_split_xy(spark, d):
    """Every slot of every feature vector beside its row's label: the numbers
    in feature order, then the one-hot slots of the city."""
    xy = forecast.split_xy(features_ckpt(spark, d), FEATURES)
    return xy.select(F.posexplode(vector_to_array("features")).alias("slot", "value"), "label")


@register("train_model")
def q_train_model(spark, d):
    train = _train(spark, d)
    model, _ = forecast.train_model(train, FEATURES, "gbt")
    fit = forecast.evaluate_model(model, train)
    return fit.select(F.lit("gbt").alias("model"), F.col("rmse").alias("train_rmse"))


@register("predict")
def q_predict(spark, d):
    model, _ = forecast.train_model(_train(spark, d), FEATURES, "gbt")
    return forecast.predict(model, _reference_rows(spark, d))


@register("evaluate_model")
def q_evaluate_model(spark, d):
    """Both modes: the reference window as test set, the last batch as fresh one."""
    model, _ = forecast.train_model(_train(spark, d), FEATURES, "gbt")
    last = schedule(spark, d).filter(F.col("batch") == config.BATCH_COUNT).first()
    fresh = pp.evaluation_slice(features_ckpt(spark, d, "eval"), last["batch_start"], last["batch_end"], config.HORIZON)
    rows = {"test_set": _reference_rows(spark, d), "fresh_batch": fresh}
    scores = [forecast.evaluate_model(model, rows[m]).select(F.lit(m).alias("mode"), "rmse") for m in forecast.EVAL_MODES]
    return scores[0].unionByName(scores[1])


@register("model_comparison")
def q_model_comparison(spark, d):
    """Families on the selected features, and boosted trees on the 14- and
    21-lag sets too, one-hot and with the city as a category."""
    trees = {"gbt": dict(kind="gbt"), "gbt_city_categorical": dict(kind="gbt", categorical_native=True)}
    families = {"linear": dict(kind="linear"), "rf": dict(kind="rf"), **trees}
    out = forecast.model_comparison({"custom": (features_ckpt(spark, d), FEATURES)}, families)
    for approach in ("all_lags_14", "all_lags_21"):
        cfg = pp.with_approach(config.PreprocessConfig(), approach)
        rows = pp.preprocess_train(readings(spark, d), weather(spark, d), cfg).checkpoint(eager=True)
        out = out.unionByName(forecast.model_comparison({approach: (rows, list(cfg.features))}, trees))
    return forecast.fold_summary(out, key=["feature_set", "model"])


def _ridge_sql(body: str, prefixes: str, l2: float) -> str:
    """Normal equations of standardised features on every fold and feature prefix, solved by
    Gauss-Jordan elimination over lists; ``weights``: (fold, k, w, icept)."""
    slots = ", ".join(f"CAST({f} AS DOUBLE)" for f in FEATURES if f != "city")
    numeric = [f for f in FEATURES if f != "city"]
    at = ", ".join(str(FEATURES.index(f) + 1) for f in numeric)  # rank of each numeric slot
    extra = FOLD_CTES | {
        "cs": "SELECT list(DISTINCT city ORDER BY city) AS cs FROM full_train",
        "x": f"SELECT date, target AS y, list_concat([{slots}], list_transform(cs, lambda c: CASE WHEN c = city THEN 1.0 ELSE 0.0 END::DOUBLE)) AS v FROM full_train, cs",
        "ranks": f"SELECT list_concat([{at}], list_transform(cs, lambda c: {FEATURES.index('city') + 1})) AS rk, len(cs) + {len(numeric)} AS p FROM cs",
        "tr": "SELECT f.fold, x.* FROM x JOIN folds f ON f.role = 'train' AND x.date BETWEEN f.start AND f.\"end\"",
        "moments": """
SELECT fold, i, avg(v[i]) AS m, CASE WHEN stddev_pop(v[i]) <= 1e-7 * abs(avg(v[i])) OR stddev_pop(v[i]) = 0 THEN NULL ELSE stddev_pop(v[i]) END AS sd,
  covar_pop(v[i], y) AS cy, avg(y) AS my FROM tr, ranks, range(1, p + 1) t(i) GROUP BY fold, i""",
        "products": "SELECT fold, i, j, covar_pop(v[i], v[j]) AS c FROM tr, ranks, range(1, p + 1) a(i), range(1, p + 1) b(j) GROUP BY fold, i, j",
        "prefix": prefixes,
        "entries": f"""
SELECT q.fold, k, q.i, list(coalesce(CASE WHEN r.rk[q.i] <= k AND r.rk[q.j] <= k THEN q.c / a.sd / b.sd END, 0.0)
    + CASE WHEN q.i = q.j THEN {l2} ELSE 0.0 END ORDER BY q.j) || [coalesce(CASE WHEN r.rk[q.i] <= k THEN any_value(a.cy) / any_value(a.sd) END, 0.0)] AS line
FROM products q JOIN moments a ON a.fold = q.fold AND a.i = q.i JOIN moments b ON b.fold = q.fold AND b.i = q.j, ranks r, prefix
GROUP BY q.fold, k, q.i, r.rk""",
        "gj": """
SELECT fold, k, 0 AS step, list(line ORDER BY i) AS m FROM entries GROUP BY fold, k
UNION ALL
SELECT fold, k, step + 1, list_transform(m, lambda l, i: CASE WHEN i = step + 1 THEN list_transform(l, lambda e: e / l[step + 1])
  ELSE list_transform(l, lambda e, j: e - l[step + 1] * m[step + 1][j] / m[step + 1][step + 1]) END)
FROM gj, ranks WHERE step < p""",
        "scaled": "SELECT g.fold, k, i, g.m[i][p + 1] / a.sd AS w, a.m AS mean, a.my FROM gj g, ranks, moments a WHERE g.step = p AND a.fold = g.fold",
        "weights": "SELECT fold, k, list(coalesce(w, 0.0) ORDER BY i) AS w, any_value(my) - sum(coalesce(w, 0.0) * mean) AS icept FROM scaled GROUP BY fold, k",
        "scores": """
SELECT w.fold, k, sqrt(avg(power(y - icept - list_sum(list_transform(v, lambda e, i: e * w.w[i])), 2))) AS rmse
FROM x JOIN folds f ON f.role = 'test' AND x.date BETWEEN f.start AND f."end" JOIN weights w ON w.fold = f.fold GROUP BY w.fold, k""",
    }
    sql = with_ctes(body, "full_train", extra=extra)
    return "WITH RECURSIVE" + sql[len("WITH"):]


_RIDGE = gram.FAMILIES["ridge"]


@register("ridge_crossval", _ridge_sql("SELECT 'ridge' AS model, fold, rmse FROM scores", f"SELECT {len(FEATURES)} AS k", _RIDGE[1]), ["rmse"])
def q_ridge_crossval(spark, d):
    """Ridge on every fold, from one pass over the rows."""
    feats = features_ckpt(spark, d)
    return gram.linear_crossval(feats, FEATURES, forecast.time_folds(feats), {"ridge": _RIDGE})


@register(
    "topk_linear",
    _ridge_sql("SELECT CAST(k AS BIGINT) AS nb_features, avg(rmse) AS score, stddev_pop(rmse) AS std_score FROM scores GROUP BY k",
               f"SELECT k FROM range(4, {len(FEATURES) + 1}) t(k)", _RIDGE[1]),
    ["score", "std_score"],
)
def q_topk_linear(spark, d):
    """Ridge on every prefix of the feature list and every fold, from one pass over the rows."""
    feats = features_ckpt(spark, d)
    return gram.linear_topk(feats, FEATURES, forecast.time_folds(feats), penalty=_RIDGE)


@register("categorical_native")
def q_categorical_native(spark, d):
    df = features_ckpt(spark, d)
    sc = forecast.cross_validate(df, FEATURES, "gbt", categorical_native=True)
    return forecast.fold_summary(sc.withColumn("model", F.lit("gbt_city_categorical")), key="model")


def _importances(spark, d, feats=None, evaluated=None):
    train = _train(spark, d, feats, evaluated)
    model, _ = forecast.train_model(train, FEATURES, "gbt")
    return forecast.permutation_importance(model, train, FEATURES)


def _ranked(spark, d, feats=None, evaluated=None, k=None):
    return forecast.rank_features(_importances(spark, d, feats, evaluated).select("feature", F.col("importance_mean").alias("importance")), k)


@register("permutation_importance")
def q_permutation_importance(spark, d):
    return _importances(spark, d)


@register("rank_features")
def q_rank_features(spark, d):
    """Top 10 features by permutation importance (the limit is the feature)."""
    return _ranked(spark, d, k=10)


@register("topk_sweep")
def q_topk_sweep(spark, d):
    feats, evaluated = _both_modes(spark, d)
    ranked = [r["feature"] for r in _ranked(spark, d, feats, evaluated).collect()]
    return forecast.topk_sweep(feats, ranked)


@register("param_search")
def q_param_search(spark, d):
    return forecast.param_search(features_ckpt(spark, d), FEATURES, forecast.sample_params(config.SEARCH_TRIALS))


# --- flows -------------------------------------------------------------------

def _sources(spark, d):
    days = lambda df: lambda start, end: df.filter(F.col("date").between(F.lit(start), F.lit(end)))
    return flows.Sources(airqual=days(readings(spark, d)), weather=days(weather(spark, d)))


def _trained(spark, d):
    """A workspace with a champion fitted on the days before the reference window."""
    ws = flows.Workspace(scratch_path(spark, "flows"))
    lo, hi = _reference_window(spark, d)
    first = weather(spark, d).agg(F.min("date")).first()[0]
    flows.bootstrap_train_flow(spark, ws, _sources(spark, d), first, lo - dt.timedelta(days=1), FEATURES, "gbt")
    return ws, lo, hi


def _bootstrapped(spark, d):
    ws, lo, hi = _trained(spark, d)
    flows.bootstrap_eval_flow(spark, ws, _sources(spark, d), lo, hi)
    return ws


REFERENCE_START = {"refstart": "SELECT CAST(batch_start - 42 AS DATE) AS lo FROM sched WHERE batch = 1"}


@register(
    "bootstrap_train",
    with_ctes("""
SELECT '1' AS model_version, min(date) AS train_start, max(date) AS train_end, CAST(NULL AS VARCHAR) AS eval_start,
  CAST(NULL AS VARCHAR) AS eval_end, CAST(NULL AS DOUBLE) AS reference_rmse, 'champion' AS alias FROM full_train_w""",
              "full_eval", extra={**SCHED_CTES, **REFERENCE_START, **windowed("w", "train", "date < (SELECT lo FROM refstart)")}),
)
def q_bootstrap_train(spark, d):
    ws, _, _ = _trained(spark, d)
    # not evaluated yet: both days are null
    return storage.read_table(spark, ws.models).withColumns({c: F.col(c).cast("string") for c in ("eval_start", "eval_end")})


@register("bootstrap_eval")
def q_bootstrap_eval(spark, d):
    return storage.read_table(spark, _bootstrapped(spark, d).models)


def _step(spark, d, ws):
    sources = _sources(spark, d)
    sc = schedule(spark, d).checkpoint(eager=True)
    return lambda b: flows.periodic_flow(spark, ws, sources, sc, b, FEATURES, "gbt")


@register("periodic_step")
def q_periodic_step(spark, d):
    ws = _bootstrapped(spark, d)
    step = _step(spark, d, ws)
    for b in range(1, config.BATCH_COUNT + 1):
        step(b)
    return storage.read_table(spark, ws.batches)


@register(
    "replay_events",
    with_ctes("""
SELECT batch_start, batch_end, CAST(1 AS BIGINT) AS scored, CAST(1 AS BIGINT) AS champions, true AS batch_agrees, true AS models_agree
FROM sched""", "full_eval", extra=SCHED_CTES),
)
def q_replay_events(spark, d):
    """The whole loop with ridge models, then its event log folded: each batch scored once, the
    folded batch log and registry equal to the tables, one champion at the end of every batch."""
    sources = _sources(spark, d)
    ws = flows.Workspace(scratch_path(spark, "replay"))
    lo, hi = _reference_window(spark, d)
    first = weather(spark, d).agg(F.min("date")).first()[0]
    flows.bootstrap_train_flow(spark, ws, sources, first, lo - dt.timedelta(days=1), FEATURES, "ridge")
    flows.bootstrap_eval_flow(spark, ws, sources, lo, hi)
    sc = schedule(spark, d).checkpoint(eager=True)
    for b in range(1, config.BATCH_COUNT + 1):
        flows.periodic_flow(spark, ws, sources, sc, b, FEATURES, "ridge")
    log = loop_log.read(spark, ws.events).checkpoint()
    models_agree = loop_log.agrees(loop_log.fold_models(log), storage.read_table(spark, ws.models))
    held = storage.read_table(spark, ws.batches)
    folded = loop_log.fold_batches(log)
    same = folded.join(held.select("batch_start", F.struct(*held.columns).alias("_held")), "batch_start", "left")
    same = same.select("batch_start", "batch_end", F.struct(*[F.col(c) for c in held.columns]).eqNullSafe(F.col("_held")).alias("batch_agrees"))
    scored = log.groupBy("batch_start").agg(F.count_if(F.col("kind") == loop_log.SCORED).alias("scored"))
    ends = {r["batch_start"]: r["at"] for r in log.where("batch_start IS NOT NULL").groupBy("batch_start").agg(F.max("at").alias("at")).collect()}  # one row per batch
    champions = [(s, loop_log.fold_models(loop_log.read(spark, ws.events, at)).where(F.col("alias") == config.CHAMPION).count()) for s, at in ends.items()]
    champions = spark.createDataFrame(champions, "batch_start date, champions long")
    return same.join(scored, "batch_start").join(champions, "batch_start").withColumn("models_agree", F.lit(models_agree))


@register("stream_periodic")
def q_stream_periodic(spark, d):
    ws = _bootstrapped(spark, d)
    arrivals, ckpt = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-ckpt")
    step = _step(spark, d, ws)
    # batches arrive one after another (6 schedule rows); the stream runs after each arrival
    for r in sorted(schedule(spark, d).select("batch").collect()):
        spark.createDataFrame([(r["batch"],)], "batch long").coalesce(1).write.json(f"{arrivals}/b{r['batch']:03d}")
        stream_periodic(spark, f"{arrivals}/*", ckpt, step)
    return storage.read_table(spark, ws.batches)


@register(
    "stream_daily_rollup",
    with_ctes("""
SELECT city, sensor_id, CAST(substr(ts_local, 1, 10) AS DATE) AS date, avg(value) AS pm25_avg,
  min(value) AS pm25_min, quantile_cont(value, 0.25) AS pm25_q25, quantile_cont(value, 0.5) AS pm25_median,
  quantile_cont(value, 0.75) AS pm25_q75, max(value) AS pm25_max,
  count(DISTINCT substr(ts_local, 12, 2)) * 100.0 / 24 AS coverage, count(*) AS n_readings
FROM events_raw GROUP BY 1, 2, 3""", "events_raw"),
    ROLLUP_DOUBLES,
)
def q_stream_daily_rollup(spark, d):
    src = scratch_path(spark, "raw-readings")
    ev = events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out, ckpt = scratch_path(spark, "rollup-table"), scratch_path(spark, "rollup-ckpt")
    # data arrives in 8 event-time slices; the stream runs after each arrival
    write_arrivals(ev, src, slices=8, on_arrival=lambda _: stream_daily_rollup(spark, f"{src}/slice=*", out, ckpt))
    return storage.read_table(spark, out)

