"""Model monitoring: batch schedule, batch scoring, drift and promotion
decisions, the model registry table and dashboard views.

Monitoring tables are small (one row per batch / model version / prediction
day and city); they are plain DataFrames written through
``smogline.sources.storage`` key-replace and range-replace writers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from .. import functions as fx
from ..operators import joins
from ..operators.stats import rmse_col, rmsle_col


# --- schedule ---------------------------------------------------------------

def batch_schedule(
    df: DataFrame, n_batches: int = config.BATCH_COUNT, days: int = config.BATCH_DAYS
) -> DataFrame:
    """The last ``n_batches`` windows of ``days`` days ending at the data's last day.

    (batch, batch_start, batch_end, train_start, train_end, warmup_start);
    train_start is the first day of the data, train_end the day before the
    batch.  Built from one (min, max) aggregate; ``n_batches`` rows.
    """
    b = df.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    start0 = F.date_sub(F.col("last"), n_batches * days - 1)
    starts = F.sequence(start0, F.date_add(start0, (n_batches - 1) * days), F.expr(f"INTERVAL {days} DAYS"))
    return b.select("first", F.posexplode(starts).alias("i", "batch_start")).select(
        (F.col("i") + 1).cast("long").alias("batch"),
        "batch_start",
        F.date_add("batch_start", days - 1).alias("batch_end"),
        F.col("first").alias("train_start"),
        F.date_sub("batch_start", 1).alias("train_end"),
        fx.warmup_start("batch_start").alias("warmup_start"),
    )


def batch_by_number(schedule: DataFrame, batch: int) -> DataFrame:
    out = schedule.filter(F.col("batch") == batch)
    if out.isEmpty():
        raise ValueError(f"unknown batch {batch}")
    return out


# --- predictions and scores --------------------------------------------------

def persistence_predictions(features: DataFrame, model_version: str = "1") -> DataFrame:
    """Predictions table of the persistence model, on the original scale."""
    return features.select(
        "date",
        "city",
        F.expm1("target").alias("y_true"),
        F.expm1("lag_1").alias("y_pred"),
        F.lit(model_version).alias("model_version"),
    )


def score_batches(predictions: DataFrame, schedule: DataFrame, ahead: int = 0) -> DataFrame:
    """RMSE (log space) per batch and model version; with ``ahead``, on the days whose day
    ``ahead`` days later is in the batch too."""
    tagged = joins.assign_batch(predictions, schedule, ahead=ahead)
    return tagged.groupBy("batch", "batch_start", "batch_end", "model_version").agg(
        rmsle_col("y_true", "y_pred").alias("rmse"), F.count(F.lit(1)).alias("n_rows")
    )


def reference_window(schedule: DataFrame, days: int = config.BATCH_DAYS) -> DataFrame:
    """The test window just before the first batch: (eval_start, eval_end, train_start)."""
    first = schedule.filter(F.col("batch") == 1)
    return first.select(
        F.date_sub("batch_start", days).alias("eval_start"),
        F.date_sub("batch_start", 1).alias("eval_end"),
        "train_start",
    )


def candidate_models(features: DataFrame, schedule: DataFrame) -> DataFrame:
    """Registry rows of the three baseline models scored on the reference window.

    Versions '1' (persistence, champion), '2' (extrapolation, challenger),
    '3' (average, archived); reference_rmse is each one's score on the
    window before the first batch.
    """
    from .forecast import baseline_col

    win = reference_window(schedule)
    rows = features.join(F.broadcast(win), F.col("date").between(F.col("eval_start"), F.date_sub("eval_end", config.HORIZON)))
    scores = rows.groupBy("eval_start", "eval_end", "train_start").agg(
        rmse_col("target", baseline_col("persistence")).alias("r1"),
        rmse_col("target", baseline_col("extrapolation")).alias("r2"),
        rmse_col("target", baseline_col("average")).alias("r3"),
    )
    return scores.selectExpr(
        "train_start",
        "date_sub(eval_start, 1) AS train_end",
        "eval_start",
        "eval_end",
        "stack(3, '1', r1, 'champion', '2', r2, 'challenger', '3', r3, 'archived') "
        "AS (model_version, reference_rmse, alias)",
    ).select("model_version", "train_start", "train_end", "eval_start", "eval_end", "reference_rmse", "alias")


def drift_check(scores: DataFrame, models: DataFrame, margin: float = config.DRIFT_THRESHOLD) -> DataFrame:
    """Batch score vs the model's stored reference: drift when ≥ ref·(1+margin%)."""
    j = joins.reference_lookup(scores, models)
    return j.withColumn("drift_detected", fx.drift_flag("rmse", "reference_rmse", margin))


def promotion_check(champion: DataFrame, challenger: DataFrame, margin: float = config.IMPROVEMENT_THRESHOLD) -> DataFrame:
    """Per batch: promote when challenger ≤ (1 - margin%) · champion."""
    c = champion.select("batch", F.col("model_version").alias("champion_version"), F.col("rmse").alias("champion_rmse"))
    h = challenger.select("batch", F.col("model_version").alias("challenger_version"), F.col("rmse").alias("rmse_challenger"))
    return c.join(h, "batch").withColumn("promote", fx.promotion_flag("rmse_challenger", "champion_rmse", margin))


def batch_log(
    features: DataFrame, schedule: DataFrame, models: DataFrame,
    champion: str = "1", challenger: str = "2",
) -> DataFrame:
    """``batches`` rows: champion score and drift; challenger scored only on drift.

    ``run_date`` is the day after the batch end (deterministic).
    """
    from .forecast import baseline_col

    names = {"1": "persistence", "2": "extrapolation", "3": "average"}
    tagged = joins.assign_batch(features, schedule, ahead=config.HORIZON)
    s = tagged.groupBy("batch", "batch_start", "batch_end").agg(
        rmse_col("target", baseline_col(names[champion])).alias("champion_rmse"),
        rmse_col("target", baseline_col(names[challenger])).alias("challenger_rmse"),
    )
    ref = models.filter(F.col("model_version") == champion).select("reference_rmse")
    j = s.withColumn("reference_rmse", ref.scalar())
    drift = fx.drift_flag("champion_rmse", "reference_rmse")
    promote = fx.promotion_flag("challenger_rmse", "champion_rmse")
    return j.select(
        "batch_start",
        "batch_end",
        F.lit(champion).alias("champion_version"),
        "champion_rmse",
        drift.alias("drift_detected"),
        F.when(drift, F.lit(challenger)).alias("challenger_version"),
        F.when(drift, F.col("challenger_rmse")).alias("rmse_challenger"),
        F.date_add("batch_end", 1).cast("timestamp_ntz").alias("run_date"),
        F.when(drift, promote).alias("promotion_applied"),
    )


# --- registry ------------------------------------------------------------------

def _number(version: str) -> Column:
    return F.col(version).cast("long")


def register_version(models: DataFrame, new: DataFrame) -> DataFrame:
    """Append versions.  An alias belongs to one version: the first ever becomes
    champion, the newest of the later ones challenger, and whatever was
    challenger before is archived.  Versions are ordered as numbers."""
    has_champion = models.filter(F.col("alias") == config.CHAMPION).select(F.count(F.lit(1)) > 0).scalar()
    first_new = new.select(F.min(_number("model_version"))).scalar()
    last_new = new.select(F.max(_number("model_version"))).scalar()
    is_first = ~has_champion & (_number("model_version") == first_new)
    alias = F.when(is_first, config.CHAMPION).when(_number("model_version") == last_new, config.CHALLENGER).otherwise(config.ARCHIVED)
    # the older challenger keeps its place only if the one new version became champion
    replaced = (F.col("alias") == config.CHALLENGER) & (has_champion | (first_new < last_new))
    kept = models.withColumn("alias", F.when(replaced, config.ARCHIVED).otherwise(F.col("alias")))
    return kept.unionByName(new.withColumn("alias", alias).select(*models.columns))


def promote_challenger(models: DataFrame, version: str | None = None) -> DataFrame:
    """``version`` (default: the newest challenger) becomes the one champion; the
    champion before is archived.  Without such a version nothing changes."""
    a = F.col("alias")
    chosen = models.filter(a == config.CHALLENGER) if version is None else models.filter(F.col("model_version") == version)
    new = chosen.select(F.max(_number("model_version"))).scalar()
    return models.withColumn(
        "alias",
        F.when(_number("model_version") == new, F.lit(config.CHAMPION)).when((a == config.CHAMPION) & new.isNotNull(), F.lit(config.ARCHIVED)).otherwise(a),
    )


def update_alias(models: DataFrame, model_version: str, new_alias: str) -> DataFrame:
    if new_alias not in (config.CHAMPION, config.CHALLENGER, config.ARCHIVED):
        raise ValueError(f"alias must be champion, challenger or archived, got {new_alias!r}")
    return models.withColumn(
        "alias", F.when(F.col("model_version") == model_version, F.lit(new_alias)).otherwise(F.col("alias"))
    )


def load_by_alias(models: DataFrame, alias: str = config.CHAMPION) -> DataFrame:
    return models.filter(F.col("alias") == alias)


# --- dashboard views ---------------------------------------------------------------

def batch_log_view(batches: DataFrame) -> DataFrame:
    """Batch cards: flags with null → false, % improvement vs the champion."""
    return batches.select(
        "batch_start",
        "batch_end",
        "champion_version",
        "champion_rmse",
        F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"),
        "challenger_version",
        "rmse_challenger",
        F.coalesce("promotion_applied", F.lit(False)).alias("promotion_applied"),
        fx.relative_improvement("rmse_challenger", "champion_rmse").alias("pct_vs_prod"),
    ).orderBy(F.col("batch_start").desc())


def select_series_range(predictions: DataFrame, city: str, start, end) -> DataFrame:
    return predictions.filter(
        (F.col("city") == city) & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ).orderBy("date")


def prediction_view(predictions: DataFrame) -> DataFrame:
    """RMSLE per city over its prediction range."""
    return predictions.groupBy("city").agg(
        F.min("date").alias("date_start"),
        F.max("date").alias("date_end"),
        rmsle_col("y_true", "y_pred").alias("rmsle"),
    )
