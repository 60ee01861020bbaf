"""Joins: weather ⋈ air quality, batch assignment, reference lookup.

Strategies are left to the planner: AQE sees the real size of each side at
run time, broadcasts a side under the broadcast threshold and otherwise
keeps the sort-merge join (splitting skewed partitions).  Only inputs with a
size fixed by construction (batch schedules, a handful of rows) get an
explicit ``broadcast`` hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from . import series


def assert_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """``df`` in the order of ``expected``, which must name exactly its columns."""
    odd = set(df.schema.fieldNames()) ^ set(expected)
    if odd:
        notes = [f"{c} ({'missing' if c in expected else 'not expected'})" for c in sorted(odd)]
        raise ValueError("columns differ: " + ", ".join(notes))
    return df.select(expected)


def merge_sources(
    airqual: DataFrame,
    weather: DataFrame,
    col_order: list[str] = config.MERGED_COLUMNS,
    validate: bool = True,
) -> DataFrame:
    """Weather LEFT JOIN air quality on (date, city).

    Every weather day is kept; days without air-quality rows carry nulls.
    With ``validate`` one small job on the weather side checks that each
    city's days are contiguous and that there is at least one row (the
    merge is a left join, so it is empty exactly when weather is).  Callers
    that window over the merge anyway can pass ``validate=False`` and let
    ``impute_gaps(check_contiguous=True)`` check inside their own job.
    """
    if validate:
        series.assert_contiguous(weather)
    merged = weather.join(airqual, ["date", "city"], "left")
    return assert_columns(merged, list(col_order))


def assign_batch(df: DataFrame, schedule: DataFrame, date_col: str = "date", ahead: int = 0) -> DataFrame:
    """Attach ``batch`` (and window bounds) to rows falling inside a batch, and whose
    day ``ahead`` days later does too.

    ``schedule`` has one row per batch: the range join is a broadcast nested
    loop over a handful of rows (a schedule is a few windows per year).
    """
    s = schedule.select("batch", "batch_start", "batch_end")
    cond = (F.col(date_col) >= F.col("batch_start")) & (F.col(date_col) <= F.date_sub("batch_end", ahead))
    return df.join(F.broadcast(s), cond, "inner")


def reference_lookup(scores: DataFrame, models: DataFrame) -> DataFrame:
    """Join each batch score with the stored reference score of its model."""
    ref = models.select("model_version", "reference_rmse")
    return scores.join(ref, "model_version", "left")
