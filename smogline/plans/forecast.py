"""Baselines, expanding time folds and MLlib model jobs.

Time folds are defined on dates, not row numbers: the distinct-date table
(bounded by the calendar, a few thousand rows for decades of history) is
ranked once, fold cut-offs are aggregated from it (2 rows per fold), and
the data rows pick their fold by a broadcast range join against those few
cut-off rows.  Every fold and every baseline is scored in one aggregation.
"""

from __future__ import annotations

import math
import random
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from .. import functions as fx
from ..operators.stats import rmse_col

BASELINES = ("persistence", "extrapolation", "average")


def baseline_col(name: str) -> Column:
    """Prediction of a baseline from the (log-space) lag columns."""
    if name == "persistence":
        return F.col("lag_1")
    if name == "extrapolation":
        return fx.clip_lower(F.col("lag_1") + (F.col("lag_1") - F.col("lag_2")), 0.001)
    if name == "average":
        lags = [F.col(f"lag_{i}") for i in (1, 2, 3)]
        known = sum(F.when(c.isNotNull(), 1).otherwise(0) for c in lags)
        # the mean of the lags that are there; null if none is
        return F.when(known > 0, sum(F.coalesce(c, F.lit(0.0)) for c in lags) / known)
    raise ValueError(f"baseline must be one of {BASELINES}, got {name!r}")


def baseline_predictions(df: DataFrame, name: str) -> DataFrame:
    return df.select("city", "date", "target", baseline_col(name).alias("y_pred"))



# --- time folds -------------------------------------------------------------

def time_folds(
    df: DataFrame,
    n_folds: int = config.FOLD_COUNT,
    test_days: int = config.FOLD_TEST_DAYS,
    gap_days: int = config.FOLD_GAP_DAYS,
) -> DataFrame:
    """Expanding-window folds on distinct dates: (fold, role, start, end).

    Fold f (1..n) tests the dates ranked ((n-f)·T, (n-f+1)·T] from the most
    recent one; its training set is every date ranked after the test block
    plus ``gap_days``.  Dates are ranked inside their year (a window per
    year) plus the count of dates in later years, so the only unpartitioned
    window runs over one row per year.
    """
    dates = df.select("date").distinct().withColumn("_y", F.year("date"))
    # rank from the most recent date: rank inside the year (partitioned window)
    # + number of dates in later years (a running sum over one row per year)
    years = dates.groupBy("_y").agg(F.count(F.lit(1)).alias("_n"))
    later = Window.orderBy(F.col("_y").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = years.select("_y", F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_off"))
    in_year = F.row_number().over(Window.partitionBy("_y").orderBy(F.col("date").desc()))
    ranked = dates.withColumn("_ry", in_year).join(offsets, "_y").select(
        "date", (F.col("_off") + F.col("_ry")).alias("r")
    )
    per_fold = ranked.select("date", "r", F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold"))
    lo = (F.lit(n_folds) - F.col("fold")) * test_days
    hi = lo + test_days
    role = F.when((F.col("r") > lo) & (F.col("r") <= hi), F.lit("test")).when(
        F.col("r") > hi + gap_days, F.lit("train")
    )
    return (
        per_fold.withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .groupBy(F.col("fold").cast("long").alias("fold"), "role")
        .agg(F.min("date").alias("start"), F.max("date").alias("end"))
    )


def fold_rows(df: DataFrame, folds: DataFrame, role: str = "test") -> DataFrame:
    """Rows of ``df`` tagged with each fold whose ``role`` range holds them."""
    f = folds.filter(F.col("role") == role).select("fold", "start", "end")
    return df.join(F.broadcast(f), (F.col("date") >= F.col("start")) & (F.col("date") <= F.col("end"))).drop(
        "start", "end"
    )


def baseline_crossval(df: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """RMSE of each baseline on each fold's test block: (fold, baseline, rmse)."""
    folds = time_folds(df) if folds is None else folds
    val = fold_rows(df, folds, "test")
    wide = val.groupBy("fold").agg(*[rmse_col("target", baseline_col(b)).alias(b) for b in BASELINES])
    parts = ", ".join(f"'{b}', {b}" for b in BASELINES)
    return wide.selectExpr("fold", f"stack({len(BASELINES)}, {parts}) AS (baseline, rmse)")


def fold_summary(scores: DataFrame, key: str | list[str] = "baseline") -> DataFrame:
    """Mean and population std of fold scores per model/baseline."""
    aggs = [F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse")]
    if "fit_seconds" in scores.columns:
        aggs.append(F.avg("fit_seconds").alias("mean_fit_seconds"))
    return scores.groupBy(*([key] if isinstance(key, str) else key)).agg(*aggs)


# --- MLlib models -------------------------------------------------------------

def _numeric(features: list[str]) -> list[str]:
    return [f for f in features if f != "city"]


def split_xy(df: DataFrame, features: list[str], label: str = "target") -> DataFrame:
    """Feature vector + label (date excluded); city is one-hot encoded."""
    model = encoder_stages(features)
    return Pipeline(stages=model).fit(df).transform(df).select("features", F.col(label).alias("label"))


def encoder_stages(features: list[str], categorical_native: bool = False) -> list:
    """City → index (unseen cities kept as an extra index) → one-hot with the
    last slot dropped, so an unseen city encodes to all zeros."""
    stages = []
    inputs = _numeric(features)
    if "city" in features:
        stages.append(StringIndexer(inputCol="city", outputCol="city_idx", handleInvalid="keep"))
        if categorical_native:
            inputs = inputs + ["city_idx"]
        else:
            stages.append(OneHotEncoder(inputCols=["city_idx"], outputCols=["city_ohe"], dropLast=True))
            inputs = inputs + ["city_ohe"]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def make_regressor(kind: str = "gbt", **params):
    if kind == "gbt":
        p = dict(config.GBT_PARAMS)
        p.update(params)
        return GBTRegressor(featuresCol="features", labelCol="target", **p)
    if kind == "rf":
        p = dict(numTrees=50, maxDepth=8, seed=config.RANDOM_SEED)
        p.update(params)
        return RandomForestRegressor(featuresCol="features", labelCol="target", **p)
    if kind == "linear":
        p = dict(regParam=0.01, elasticNetParam=0.5)
        p.update(params)
        return LinearRegression(featuresCol="scaled", labelCol="target", **p)
    if kind == "ridge":
        p = dict(regParam=0.01, elasticNetParam=0.0, solver="normal")
        p.update(params)
        return LinearRegression(featuresCol="scaled", labelCol="target", **p)
    raise ValueError(f"unknown model kind {kind!r}")


def model_pipeline(features: list[str], kind: str = "gbt", categorical_native: bool = False, **params) -> Pipeline:
    stages = encoder_stages(features, categorical_native)
    if kind in ("linear", "ridge"):
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    stages.append(make_regressor(kind, **params))
    return Pipeline(stages=stages)


def city_bins(df: DataFrame) -> int:
    """Tree bins that hold every city of ``df`` as a category, and one for unseen ones."""
    return max(32, df.agg(F.count_distinct("city")).first()[0] + 1)


def train_model(df: DataFrame, features: list[str], kind: str = "gbt", **params) -> tuple[PipelineModel, float]:
    """Fit the pipeline; returns (model, fit seconds).  No training row is an
    error (e.g. train mode when every sensor was flagged)."""
    if df.limit(1).isEmpty():
        raise ValueError("no training rows: the training window is empty after preprocessing")
    if params.get("categorical_native"):
        params.setdefault("maxBins", city_bins(df))
    t0 = time.perf_counter()
    model = model_pipeline(features, kind, **params).fit(df)
    return model, time.perf_counter() - t0


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select("city", "date", "target", F.col("prediction").alias("y_pred"))


EVAL_MODES = ("test_set", "fresh_batch")


def check_mode(mode: str) -> str:
    if mode not in EVAL_MODES:
        raise ValueError(f"mode must be one of {EVAL_MODES}, got {mode!r}")
    return mode


def evaluate_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row: RMSE in log space."""
    return predict(model, df).agg(rmse_col("target", "y_pred").alias("rmse"))


def model_comparison(sets: dict[str, tuple[DataFrame, list[str]]], kinds: dict[str, dict]) -> DataFrame:
    """Fold scores of model families on several feature sets: (feature_set, model, fold, rmse).

    ``sets``: name -> (rows, features).  ``kinds``: name -> arguments of
    ``cross_validate``, its ``kind`` among them.  Each fit is a distributed
    MLlib job; the loop only sequences them.
    """
    out = None
    for set_name, (df, features) in sets.items():
        folds = time_folds(df).cache()
        for name, params in kinds.items():
            scores = cross_validate(df, features, folds=folds, **params).select(
                F.lit(set_name).alias("feature_set"), F.lit(name).alias("model"), "fold", "rmse")
            out = scores if out is None else out.unionByName(scores)
        folds.unpersist()
    if out is None:
        raise ValueError("nothing to compare")
    return out


def feature_importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """Tree-model importances per input feature (city slots summed)."""
    reg = model.stages[-1]
    imp = reg.featureImportances.toArray()
    names = _numeric(features)
    vals = {n: float(imp[i]) for i, n in enumerate(names)}
    if "city" in features:
        vals["city"] = float(imp[len(names):].sum())
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(sorted(vals.items()), "feature string, importance double")


def rank_features(importances: DataFrame, k: int | None = None) -> DataFrame:
    """Features by importance, descending; top ``k`` when given."""
    out = importances.orderBy(F.col("importance").desc(), F.col("feature"))
    return out.limit(k) if k else out


# --- cross-validation, importance, feature and parameter searches -------------

def cross_validate(df: DataFrame, features: list[str], kind: str = "gbt", folds: DataFrame | None = None,
                   threads: int = 4, categorical_native: bool = False, **params) -> DataFrame:
    """Fold scores of one model: (fold, rmse, fit_seconds).

    The fold fits are independent Spark jobs; a small thread pool submits
    them concurrently so the cluster runs several fits at once.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = df.sparkSession
    folds = time_folds(df) if folds is None else folds
    if categorical_native:
        params.setdefault("maxBins", city_bins(df))
    bounds = {(r["fold"], r["role"]): (r["start"], r["end"]) for r in folds.collect()}  # 2 rows per fold
    fold_ids = sorted({f for f, role in bounds if role == "test" and (f, "train") in bounds})

    def one(f):
        tr, te = bounds[(f, "train")], bounds[(f, "test")]
        train = df.filter(F.col("date").between(tr[0], tr[1]))
        test = df.filter(F.col("date").between(te[0], te[1]))
        t0 = time.perf_counter()
        model = model_pipeline(features, kind, categorical_native, **params).fit(train)
        secs = time.perf_counter() - t0
        return int(f), float(evaluate_model(model, test).first()["rmse"]), float(secs)

    with ThreadPoolExecutor(max_workers=threads) as ex:
        rows = list(ex.map(one, fold_ids))
    return spark.createDataFrame(rows, "fold long, rmse double, fit_seconds double")


def row_ranks(df: DataFrame) -> DataFrame:
    """``df`` with ``_rank``, the dense number from 0 of each row in (date, city) order.

    Rows are numbered inside their day; the days' offsets are running sums over the calendar,
    by year and inside the year, so no window holds more than a year's days or a day's series.
    """
    days = df.groupBy("date").agg(F.count(F.lit(1)).alias("_n")).withColumn("_y", F.year("date"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    years = days.groupBy("_y").agg(F.sum("_n").alias("_n")).select("_y", before(Window.orderBy("_y")).alias("_year_off"))
    offsets = days.select("date", "_y", before(Window.partitionBy("_y").orderBy("date")).alias("_day_off")).join(years, "_y")
    at = F.row_number().over(Window.partitionBy("date").orderBy("city")) - 1
    ranked = df.withColumn("_at", at).join(offsets.select("date", (F.col("_year_off") + F.col("_day_off")).alias("_off")), "date")
    return ranked.select(*df.columns, (F.col("_off") + F.col("_at")).alias("_rank"))


_ROUNDS, _WALKS = 6, 64


def keyed_bijection(x: Column, n: int, key: Column) -> Column:
    """A bijection of 0..n-1, another one for each ``key``.

    A Feistel network on the pairs (x % a, x // a), a = ceil(sqrt(n)); its domain has at most a - 1
    numbers from n on, and from such a number the walk goes on until it is back below n.
    """
    a = max(1, math.isqrt(n - 1) + 1) if n > 1 else 1
    b = max(1, -(-n // a))

    def step(state, i):
        left, right = state["l"], state["r"]
        odd = i % 2 == 1
        noise = F.xxhash64(F.when(odd, left).otherwise(right), key, i)
        return F.struct(
            F.when(odd, left).otherwise((left + F.pmod(noise, F.lit(a))) % a).alias("l"),
            F.when(odd, (right + F.pmod(noise, F.lit(b))) % b).otherwise(right).alias("r"),
        )

    def once(v: Column) -> Column:
        halves = F.struct((v % a).cast("long").alias("l"), F.floor(v / a).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS - 1)), halves, step, lambda s: s["r"] * a + s["l"])

    out = F.aggregate(F.sequence(F.lit(1), F.lit(_WALKS)), once(x), lambda v, _: F.when(v < n, v).otherwise(once(v)))
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("the walk left the domain")).cast("long"))


def permuted(df: DataFrame, features: list[str], repeats: int, seed: int) -> DataFrame:
    """Copies of ``df``, one for each (feature ``_feature``, repeat ``_rep``), in which that feature is
    permuted across all rows.  One shuffle: the values travel to the rows that receive them."""
    ranked = row_ranks(df).checkpoint()
    n = ranked.count()
    numeric = _numeric(features)
    copies = F.explode(F.sequence(F.lit(0), F.lit(len(features) * repeats - 1)))
    at = F.floor(F.col("_copy") / repeats).cast("int")
    value = F.element_at(F.array(*[F.col(f).cast("double") if f in numeric else F.lit(None).cast("double") for f in features]), at + 1)
    sent = ranked.withColumn("_copy", copies).select(
        keyed_bijection(F.col("_rank"), n, F.col("_copy") + F.lit(1000 * seed)).alias("_rank"),
        at.alias("_feature"),
        (F.col("_copy") % repeats).alias("_rep"),
        value.alias("_value"),
        *([F.when(F.lit(features.index("city")) == at, F.col("city")).alias("_city")] if "city" in features else []),
    )
    given = {f: F.col("_city") if f == "city" else F.col("_value").cast(df.schema[f].dataType) for f in features}
    out = [F.when(F.col("_feature") == features.index(c), given[c]).otherwise(F.col(c)).alias(c) if c in features else F.col(c) for c in df.columns]
    return ranked.join(sent, "_rank").select(*out, "_feature", "_rep")


def permutation_importance(model: PipelineModel, df: DataFrame, features: list[str], repeats: int = 3,
                           seed: int = config.RANDOM_SEED) -> DataFrame:
    """RMSE increase when each feature is permuted: (feature, importance_mean, importance_std).

    All features and repeats are scored by one job.  ``df`` has one row per (city, date).
    """
    spark = df.sparkSession
    base = evaluate_model(model, df).first()["rmse"]
    scores = model.transform(permuted(df, features, repeats, seed)).groupBy("_feature", "_rep").agg(rmse_col("target", "prediction").alias("rmse"))
    rows = [(features[r["_feature"]], int(r["_rep"]), float(r["rmse"] - base)) for r in scores.collect()]  # features x repeats
    imp = spark.createDataFrame(rows, "feature string, rep long, delta double")
    return imp.groupBy("feature").agg(
        F.avg("delta").alias("importance_mean"), F.stddev_pop("delta").alias("importance_std")
    )


def parallel_fits(spark: SparkSession, work, items: list, threads: int | None = None) -> list:
    """``work(item)`` for all items from a pool of threads, in order.

    Each thread submits its Spark jobs into a scheduler pool of its own, so under
    ``spark.scheduler.mode=FAIR`` no fit waits behind another one's stages.
    """
    from concurrent.futures import ThreadPoolExecutor

    threads = threads or max(2, min(32, spark.sparkContext.defaultParallelism))

    def one(numbered):
        i, item = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{i % threads}")
        return work(item)

    with ThreadPoolExecutor(max_workers=threads) as ex:
        return list(ex.map(one, enumerate(items)))


class FoldTable:
    """Vectors of all features beside date and label, stored once; fits take a slice of the
    vector and the days of a fold.  The city's encoding is fitted on all rows: a slot of a city
    that a fold's training days do not hold is zero in all of them, so no tree splits on it."""

    #: rows of a partition; a small table is one partition, a fit's jobs then one task each
    ROWS = 250_000

    def __init__(self, df: DataFrame, features: list[str], folds: DataFrame | None = None):
        bounds = {(int(r["fold"]), r["role"]): (r["start"], r["end"]) for r in (time_folds(df) if folds is None else folds).collect()}  # 2 rows per fold
        self.bounds = bounds
        self.folds = sorted({f for f, role in bounds if role == "test" and (f, "train") in bounds})
        self.features = list(features)
        self.spark = df.sparkSession
        if self.folds:
            parts = -(-df.count() // self.ROWS)
            vectors = Pipeline(stages=encoder_stages(features)).fit(df).transform(df).select("date", "target", "features")
            self.rows = vectors.coalesce(max(1, parts)).checkpoint()
            self.size = self.rows.select(F.size(vector_to_array("features"))).first()[0]

    def slots(self, features: list[str]) -> list[int]:
        """Places of the features in the vector."""
        numeric = _numeric(self.features)
        return [numeric.index(f) for f in features if f != "city"] + (list(range(len(numeric), self.size)) if "city" in features else [])

    def score(self, fold: int, features: list[str], stop_days: int = 0, tolerance: float = 0.0, **params) -> tuple[float | None, int]:
        """Test RMSE of boosted trees on a fold, and the rounds they took.

        With ``stop_days``, the last days of the training span choose the rounds: fitting stops at
        the first round that does not lower their error by more than ``tolerance`` of it.  A span of
        under three times that many days is used for fitting alone.
        """
        (lo, hi), (tlo, thi) = self.bounds[fold, "train"], self.bounds[fold, "test"]
        slicer = VectorSlicer(inputCol="features", outputCol="sliced", indices=self.slots(features))
        rows = lambda a, b: slicer.transform(self.rows.filter(F.col("date").between(a, b)))
        train = rows(lo, hi)
        model = make_regressor("gbt", **params).setFeaturesCol("sliced")
        if stop_days and (hi - lo).days >= 3 * stop_days:
            train = train.withColumn("held", F.col("date") > F.date_sub(F.lit(hi), stop_days))
            model = model.setValidationIndicatorCol("held").setParams(validationTol=tolerance)
        fitted = model.fit(train)
        return fitted.transform(rows(tlo, thi)).agg(rmse_col("target", "prediction")).first()[0], fitted.getNumTrees


def _summary(scores: list[float | None]) -> tuple[float, float]:
    known = [s for s in scores if s is not None]
    mean = sum(known) / len(known)
    return mean, math.sqrt(sum((s - mean) ** 2 for s in known) / len(known))


def topk_sweep(df: DataFrame, ranked: list[str], kmin: int = 4, stop_days: int = config.FOLD_TEST_DAYS, threads: int | None = None, **params) -> DataFrame:
    """CV score of boosted trees on growing prefixes of ranked features: (nb_features, score, std_score, mean_rounds).

    All (prefix, fold) fits are submitted together; each takes a slice of one stored table of vectors.
    ``config.GBT_PARAMS`` give the most rounds, ``stop_days`` ends them (``FoldTable.score``).
    """
    table = FoldTable(df, ranked)
    fits = [(k, f) for k in range(kmin, len(ranked) + 1) for f in table.folds]
    scores = parallel_fits(table.spark, lambda x: table.score(x[1], ranked[: x[0]], stop_days, **params), fits, threads)
    out = []
    for k in sorted({k for k, _ in fits}):
        mine = [s for (at, _), s in zip(fits, scores) if at == k]
        out.append((k, *_summary([s for s, _ in mine]), float(sum(n for _, n in mine)) / len(mine)))
    return table.spark.createDataFrame(out, "nb_features long, score double, std_score double, mean_rounds double")


def sample_params(trials: int, ranges: dict | None = None, seed: int = config.RANDOM_SEED) -> list[dict]:
    """Seeded draws from ranges (low, high, log scale); whole numbers where both ends are."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        point = {}
        for name, (low, high, log) in (ranges or config.SEARCH_RANGES).items():
            if isinstance(low, int) and isinstance(high, int):
                point[name] = rng.randint(low, high)
            else:
                point[name] = math.exp(rng.uniform(math.log(low), math.log(high))) if log else rng.uniform(low, high)
        out.append(point)
    return out


def halving_plan(trials: int, rounds: int, keep: int = 3, rungs: int = 3) -> list[tuple[int, int]]:
    """(points, boosting rounds) of each rung: all points begin, a ``keep``-th of them goes on with
    ``keep`` times the rounds, the last rung has ``rounds``; every rung costs about the same."""
    points = [trials // keep**i for i in range(rungs) if trials // keep**i]
    return [(n, max(1, rounds // keep ** (len(points) - 1 - i))) for i, n in enumerate(points)]


def param_search(df: DataFrame, features: list[str], points: list[dict], rounds: int = config.SEARCH_ROUNDS, keep: int = 3, rungs: int = 3,
                 threads: int | None = None) -> DataFrame:
    """Successive halving over boosting rounds: (params, rounds, rung, score, std_score), best first.

    All points are cross-validated with few rounds; the best ``1 / keep`` of them are refitted with
    ``keep`` times as many (``halving_plan``), and so on.  Each point is reported with the last rung
    that it reached; a later rung ranks before an earlier one.  Ties go to the earlier point.
    """
    import json

    table = FoldTable(df, features)
    result: dict[int, tuple] = {}
    alive = list(range(len(points)))
    for rung, (n, trees) in enumerate(halving_plan(len(points), rounds, keep, rungs), 1):
        alive = sorted(alive, key=lambda i: (result[i][2], i) if i in result else (0, i))[:n]
        fits = [(i, f) for i in alive for f in table.folds]
        scores = parallel_fits(table.spark, lambda x, t=trees: table.score(x[1], features, **{**points[x[0]], "maxIter": t})[0], fits, threads)
        if not fits:
            break
        for i in alive:
            result[i] = (trees, rung, *_summary([s for (at, _), s in zip(fits, scores) if at == i]))
    out = [(json.dumps(points[i], sort_keys=True), *r) for i, r in sorted(result.items(), key=lambda x: (-x[1][1], x[1][2], x[0]))]
    return table.spark.createDataFrame(out, "params string, rounds long, rung long, score double, std_score double")
