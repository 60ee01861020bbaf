"""Bootstrap and periodic monitoring flows.

Driver functions that sequence Spark jobs: every heavy step (feature
tables, model fits, scoring, table writes) is a distributed job; the driver
only carries scalars (scores, flags, version strings) between them.  State
lives in a workspace under the shared checkpoint folder:

    <root>/tables/airqual       raw readings, range-replaced per ingested window
    <root>/tables/weather       raw weather, likewise
    <root>/tables/processed     features and target, range-replaced per processed window
    <root>/tables/models        model registry (version, windows, reference score, alias)
    <root>/tables/batches       one row per monitored batch
    <root>/tables/predictions   predictions of the champion, range-replaced per batch
    <root>/store/<version>      saved MLlib pipeline of each version

The ``*_flow`` functions start from the raw sources: a window is ingested,
processed from its own rows alone and only then used, so no feature, target or
sensor flag of a training window knows a later day, and a batch is scored on
the days whose next day lies in it (one less than it has).

``periodic_step`` and ``periodic_flow`` are idempotent per batch (key and range
replaces), so they can run inside ``foreachBatch`` and be replayed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..sources import storage
from . import events, forecast, monitoring
from . import preprocess as pp


@dataclass(frozen=True)
class Workspace:
    root: str

    @property
    def models(self) -> str:
        return f"{self.root}/tables/models"

    @property
    def batches(self) -> str:
        return f"{self.root}/tables/batches"

    @property
    def predictions(self) -> str:
        return f"{self.root}/tables/predictions"

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    def store(self, version: str) -> str:
        return f"{self.root}/store/{version}"

    def raw(self, data_type: str) -> str:
        return f"{self.root}/tables/{data_type}"

    @property
    def processed(self) -> str:
        return self.raw("processed")


@dataclass(frozen=True)
class Sources:
    """Scans of the sources: each takes (start, end) and gives the rows of those days."""

    airqual: Callable[[dt.date, dt.date], DataFrame]
    weather: Callable[[dt.date, dt.date], DataFrame]


def ingest_window(spark: SparkSession, ws: Workspace, sources: Sources, start, end, force: bool = False) -> bool:
    """Bring [start, end] of both sources into the raw tables; True if the
    sources were read.  A window that both tables already hold rows of is left
    alone unless ``force``."""
    scans = {"airqual": sources.airqual, "weather": sources.weather}
    if not force and all(storage.exists_range(spark, ws.raw(t), start, end) for t in scans):
        return False
    for data_type, scan in scans.items():
        storage.range_replace(spark, ws.raw(data_type), scan(start, end), start, end)
    return True


def process_window(
    spark: SparkSession, ws: Workspace, start, end, mode: str = "train", warmup: int = 0,
    cfg: config.PreprocessConfig = config.PreprocessConfig(),
) -> DataFrame:
    """Replace [start, end] of the processed table by features built from the
    raw rows of [start - warmup, end] alone; returns those rows as stored."""
    first = start - dt.timedelta(days=warmup)
    airqual, weather = (storage.scan_range(spark, ws.raw(t), first, end) for t in ("airqual", "weather"))
    rows = pp.preprocess(airqual, weather, cfg, mode).filter(F.col("date") >= F.lit(start))
    storage.range_replace(spark, ws.processed, rows, start, end)
    return storage.scan_range(spark, ws.processed, start, end)


def _models_df(spark: SparkSession, ws: Workspace) -> DataFrame:
    if storage.table_exists(spark, ws.models):
        return storage.read_table(spark, ws.models)
    return spark.createDataFrame([], schemas.MODELS)


def _model_row(spark, version, train_start, train_end, eval_start=None, eval_end=None, ref=None, alias=None):
    return spark.createDataFrame(
        [(version, train_start, train_end, eval_start, eval_end, ref, alias)], schemas.MODELS
    )


def bootstrap_train(
    spark: SparkSession, ws: Workspace, train: DataFrame, features: list[str], kind: str = "gbt", **params
) -> str:
    """Fit the first model on ``train`` and register it (first → champion)."""
    bounds = train.agg(F.min("date").alias("s"), F.max("date").alias("e")).first()
    model, _ = forecast.train_model(train, features, kind, **params)
    models = _models_df(spark, ws)
    version = str(models.count() + 1)
    model.write().overwrite().save(ws.store(version))
    new = _model_row(spark, version, bounds["s"], bounds["e"]).drop("alias")
    storage.write_table(monitoring.register_version(models, new), ws.models)
    events.append(spark, ws.events, [events.event(events.REGISTERED, version, train=(bounds["s"], bounds["e"]))])
    return version


def bootstrap_eval(
    spark: SparkSession, ws: Workspace, test: DataFrame, alias: str = config.CHAMPION, mode: str = "test_set"
) -> float:
    """Score the aliased model on the test window; mode ``test_set`` also stores
    the score as the model's reference, ``fresh_batch`` leaves it alone."""
    forecast.check_mode(mode)
    models = storage.read_table(spark, ws.models)
    row = monitoring.load_by_alias(models, alias).first()
    if row is None:
        raise ValueError(f"no model with alias {alias!r}")
    model = PipelineModel.load(ws.store(row["model_version"]))
    score = forecast.evaluate_model(model, test).first()["rmse"]
    if mode != "test_set":
        return score
    b = test.agg(F.min("date").alias("s"), F.max("date").alias("e")).first()
    upd = _model_row(spark, row["model_version"], row["train_start"], row["train_end"], b["s"], b["e"], score, row["alias"])
    storage.upsert_model(spark, ws.models, upd)
    events.append(spark, ws.events, [events.event(events.EVALUATED, row["model_version"], score, window=(b["s"], b["e"]))])
    return score


def bootstrap_train_flow(
    spark: SparkSession, ws: Workspace, sources: Sources, start, end, features: list[str], kind: str = "gbt",
    force: bool = False, **params,
) -> str:
    """Ingest, process (train mode) and fit the training window [start, end]."""
    ingest_window(spark, ws, sources, start, end, force)
    return bootstrap_train(spark, ws, process_window(spark, ws, start, end), features, kind, **params)


def bootstrap_eval_flow(
    spark: SparkSession, ws: Workspace, sources: Sources, start, end, alias: str = config.CHAMPION,
    mode: str = "test_set", force: bool = False,
) -> float:
    """Ingest, process (eval mode, after the warm-up days) and score [start, end]."""
    ingest_window(spark, ws, sources, start, end, force)
    return bootstrap_eval(spark, ws, process_window(spark, ws, start, end, "eval", config.WARMUP_DAYS), alias, mode)


def periodic_flow(
    spark: SparkSession, ws: Workspace, sources: Sources, schedule: DataFrame, batch: int, features: list[str],
    kind: str = "gbt", force: bool = False, **params,
) -> dict:
    """``periodic_step`` from the raw sources: the batch is ingested and processed
    after its warm-up days; the training window only if the champion drifts."""
    b = monitoring.batch_by_number(schedule, batch).first()
    logged = None if force else _logged(spark, ws, b)
    if logged is not None:
        return logged
    ingest_window(spark, ws, sources, b["batch_start"], b["batch_end"], force)
    rows = process_window(spark, ws, b["batch_start"], b["batch_end"], "eval", config.WARMUP_DAYS)
    return _monitor(spark, ws, b, rows, lambda: process_window(spark, ws, b["train_start"], b["train_end"]), features, kind, **params)


def periodic_step(
    spark: SparkSession,
    ws: Workspace,
    eval_features: DataFrame,
    train_features: DataFrame,
    schedule: DataFrame,
    batch: int,
    features: list[str],
    kind: str = "gbt",
    force: bool = False,
    **params,
) -> dict:
    """Monitor one batch: champion score → drift → (challenger, promotion)
    → batch log → champion predictions.

    A batch that is already logged is not re-run (a replayed stream
    micro-batch must not train and register another challenger); its logged
    outcome is returned.  ``force=True`` re-runs it.
    """
    b = monitoring.batch_by_number(schedule, batch).first()
    logged = None if force else _logged(spark, ws, b)
    if logged is not None:
        return logged
    rows = pp.evaluation_slice(eval_features, b["batch_start"], b["batch_end"], config.HORIZON)
    past = train_features.filter(F.col("date").between(b["train_start"], b["train_end"]))
    return _monitor(spark, ws, b, rows, lambda: past, features, kind, **params)


def _logged(spark: SparkSession, ws: Workspace, b) -> dict | None:
    """The logged outcome of a batch, if there is one."""
    if not storage.table_exists(spark, ws.batches):
        return None
    done = storage.read_table(spark, ws.batches).filter(
        (F.col("batch_start") == F.lit(b["batch_start"])) & (F.col("batch_end") == F.lit(b["batch_end"]))
    ).first()
    if done is None:
        return None
    return {"batch": b["batch"], "champion_rmse": done["champion_rmse"], "drift": done["drift_detected"],
            "challenger_rmse": done["rmse_challenger"], "promoted": done["promotion_applied"],
            "replayed": True}


def _monitor(
    spark: SparkSession, ws: Workspace, b, rows: DataFrame, train_rows: Callable[[], DataFrame], features: list[str],
    kind: str, **params,
) -> dict:
    """Score ``rows`` of batch ``b``, train and promote on drift, write the logs."""
    start, end = b["batch_start"], b["batch_end"]
    models = storage.read_table(spark, ws.models)
    champ = monitoring.load_by_alias(models).first()
    if champ is None:
        raise ValueError("no champion model registered")
    champ_model = PipelineModel.load(ws.store(champ["model_version"]))
    champ_score = forecast.evaluate_model(champ_model, rows).first()["rmse"]
    drift = champ_score >= champ["reference_rmse"] * (1 + config.DRIFT_THRESHOLD / 100)

    chall_version = chall_score = promoted = None
    current = champ_model
    if drift:
        # a challenger already registered for this window (a replay after a
        # failure past the registry write) is reused, not trained again
        prior = models.filter(
            (F.col("eval_start") == F.lit(start)) & (F.col("eval_end") == F.lit(end))
            & (F.col("model_version") != champ["model_version"])
        ).first()
        if prior is not None:
            chall_version, chall_score = prior["model_version"], prior["reference_rmse"]
            model = PipelineModel.load(ws.store(chall_version))
        else:
            model, _ = forecast.train_model(train_rows(), features, kind, **params)
            chall_version = str(models.agg(F.max(F.col("model_version").cast("long"))).first()[0] + 1)
            model.write().overwrite().save(ws.store(chall_version))
            chall_score = forecast.evaluate_model(model, rows).first()["rmse"]
            new = _model_row(spark, chall_version, b["train_start"], b["train_end"], start, end, chall_score).drop("alias")
            models = monitoring.register_version(models, new)
        promoted = chall_score <= (1 - config.IMPROVEMENT_THRESHOLD / 100) * champ_score
        if promoted:
            models = monitoring.promote_challenger(models, chall_version)
            current = model
        if prior is None or promoted:
            storage.write_table(models, ws.models)
            if monitoring.load_by_alias(storage.read_table(spark, ws.models)).count() != 1:
                raise ValueError("the registry must hold one champion")

    log = spark.createDataFrame(
        [(start, end, champ["model_version"], champ_score, drift, chall_version, chall_score,
          dt.datetime.combine(end + dt.timedelta(days=1), dt.time()), promoted)],
        schemas.BATCHES,
    )
    happened = [events.event(events.SCORED, champ["model_version"], champ_score, batch=(start, end))]
    if drift:
        happened.append(events.event(events.DRIFTED, champ["model_version"], champ["reference_rmse"], batch=(start, end)))
        happened.append(events.event(events.TRAINED, chall_version, chall_score, (b["train_start"], b["train_end"]), (start, end), (start, end)))
    if promoted:
        happened.append(events.event(events.PROMOTED, chall_version, chall_score, batch=(start, end)))
    # the log first: a batch whose row is missing runs again, and its last attempt counts
    events.append(spark, ws.events, happened)
    storage.log_batch(spark, ws.batches, log)

    version = chall_version if promoted else champ["model_version"]
    preds = forecast.predict(current, rows).select(
        "date", "city", F.expm1("target").alias("y_true"), F.expm1("y_pred").alias("y_pred"),
        F.lit(version).alias("model_version"),
    )
    storage.log_predictions(spark, ws.predictions, preds)
    return {"batch": b["batch"], "champion_rmse": champ_score, "drift": drift, "challenger_rmse": chall_score,
            "promoted": promoted}


def next_batch(spark: SparkSession, ws: Workspace, schedule: DataFrame) -> int:
    """Batch after the last logged one (1 when nothing is logged yet)."""
    if not storage.table_exists(spark, ws.batches):
        return 1
    last = storage.read_table(spark, ws.batches).agg(F.max("batch_end")).first()[0]
    nxt = schedule.filter(F.col("batch_start") > F.lit(last)).agg(F.min("batch")).first()[0]
    if nxt is None:
        raise ValueError("every scheduled batch is already logged")
    return int(nxt)
