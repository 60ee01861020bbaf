"""The monitoring loop's append-only event log, and its folds.

Every step of the loop appends what happened: a model was registered or
evaluated; a batch was scored, drifted, had a challenger trained, promoted it.
Rows are only ever appended, one append for a step, so two readers never see
half of one, and a step that runs again appends its rows again: the folds take
a batch's last attempt.  The registry and the batch log are functions of the
log (``fold_models``, ``fold_batches``), so they can be rebuilt from it, or from
the part up to any time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config, schemas

REGISTERED, EVALUATED, SCORED, DRIFTED, TRAINED, PROMOTED = "registered", "evaluated", "scored", "drifted", "trained", "promoted"


def event(kind: str, version: str, score: float | None = None, train: tuple = (None, None), window: tuple = (None, None), batch: tuple = (None, None)) -> tuple:
    """One row: ``train`` and ``window`` are the model's training and evaluation days, ``batch`` the batch's."""
    return (kind, version, score, *train, *window, *batch)


def append(spark: SparkSession, path: str, events: list[tuple]) -> None:
    """Append the events of one step, under one time."""
    at = dt.datetime.now(dt.timezone.utc)
    rows = [(at, i, *e) for i, e in enumerate(events)]
    spark.createDataFrame(rows, schemas.EVENTS).coalesce(1).write.mode("append").json(path)


def read(spark: SparkSession, path: str, until: dt.datetime | None = None) -> DataFrame:
    log = spark.read.schema(schemas.EVENTS).json(path)
    return log if until is None else log.where(F.col("at") <= F.lit(until))


def _last_attempts(log: DataFrame) -> DataFrame:
    """A batch's events of its last attempt."""
    last = Window.partitionBy("batch_start", "batch_end")
    return log.where("batch_start IS NOT NULL").withColumn("_last", F.max("at").over(last)).where("at = _last").drop("_last")


def fold_batches(log: DataFrame) -> DataFrame:
    """The ``batches`` rows."""
    has = lambda kind: F.max(F.col("kind") == kind)
    one = lambda kind, col: F.max(F.when(F.col("kind") == kind, F.col(col)))
    out = _last_attempts(log).groupBy("batch_start", "batch_end").agg(
        one(SCORED, "model_version").alias("champion_version"), one(SCORED, "score").alias("champion_rmse"),
        has(DRIFTED).alias("drift_detected"), one(TRAINED, "model_version").alias("challenger_version"),
        one(TRAINED, "score").alias("rmse_challenger"), has(PROMOTED).alias("_promoted"))
    return out.select(
        "batch_start", "batch_end", "champion_version", "champion_rmse", "drift_detected", "challenger_version", "rmse_challenger",
        F.date_add("batch_end", 1).cast("timestamp_ntz").alias("run_date"), F.when(F.col("drift_detected"), F.col("_promoted")).alias("promotion_applied"))


def fold_models(log: DataFrame) -> DataFrame:
    """The ``models`` rows: the last promoted version is champion (the first registered one until then),
    the newest other version that came after it challenger, all else archived."""
    newest = Window.partitionBy("model_version").orderBy(F.col("at").desc(), F.col("step").desc())
    born = log.where(F.col("kind").isin(REGISTERED, TRAINED)).withColumn("_r", F.row_number().over(newest)).where("_r = 1")
    scored = log.where(F.col("kind").isin(EVALUATED, TRAINED)).withColumn("_r", F.row_number().over(newest)).where("_r = 1")
    number = F.col("model_version").cast("long")
    promoted = log.where(F.col("kind") == PROMOTED).agg(F.max(F.struct("at", "step", "model_version")).alias("p"))
    first = log.where(F.col("kind") == REGISTERED).agg(F.min(F.struct(number.alias("n"), "model_version")).alias("f"))
    held = promoted.join(first).select(F.coalesce("p.model_version", "f.model_version").alias("champion"))  # one row each
    rows = born.select("model_version", "train_start", "train_end").join(
        scored.select("model_version", "eval_start", "eval_end", F.col("score").alias("reference_rmse")), "model_version", "left").join(held)
    newest_other = Window.partitionBy(F.lit(1))
    late = F.max(F.when(number > F.col("champion").cast("long"), number)).over(newest_other)  # one row per model version
    alias = F.when(F.col("model_version") == F.col("champion"), config.CHAMPION).when(number == late, config.CHALLENGER).otherwise(config.ARCHIVED)
    return rows.select("model_version", "train_start", "train_end", "eval_start", "eval_end", "reference_rmse", alias.alias("alias"))


def agrees(folded: DataFrame, held: DataFrame) -> bool:
    """Both hold the same rows."""
    held = held.select(*folded.columns)
    return folded.exceptAll(held).isEmpty() and held.exceptAll(folded).isEmpty()
