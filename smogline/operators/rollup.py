"""Intraday → daily rollups and ingestion bookkeeping (admission of sensor
payloads, the incremental work list, completeness, unions of sources)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from .. import functions as fx
from .quantiles import grouped_quantiles

ROLLUP_KEYS = ("city", "sensor_id", "date")


def daily_rollup(raw: DataFrame, value: str = "value", local_ts: str = "ts_local") -> DataFrame:
    """Per (city, sensor, local day): avg, min, q25, median, q75, max, coverage.

    Day = first 10 characters of the local timestamp.  Coverage = percentage
    of the day's 24 local hours with at least one reading.  Quantiles are
    exact and linear.

    The raw readings are combined once, map side first, to one row per
    (sensor-day, value): how often, and a bit for every hour.  Everything else
    is derived from those rows.
    """
    keyed = raw.select(
        "city",
        "sensor_id",
        fx.local_date(local_ts).alias("date"),
        F.substring(local_ts, 12, 2).cast("int").alias("_hour"),
        F.col(value).alias("_v"),
    )
    hour_bit = F.call_function("shiftleft", F.lit(1), F.col("_hour"))
    counts = keyed.groupBy(*ROLLUP_KEYS, "_v").agg(F.count(F.lit(1)).alias("_n"), F.bit_or(hour_bit).alias("_hours"))
    n_values = F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")))
    simple = counts.groupBy(*ROLLUP_KEYS).agg(
        (F.sum(F.col("_v") * F.col("_n")) / n_values).alias("pm25_avg"),
        F.min("_v").alias("pm25_min"),
        F.max("_v").alias("pm25_max"),
        (F.coalesce(F.bit_count(F.bit_or("_hours")), F.lit(0)) * 100.0 / 24).alias("coverage"),
        F.sum("_n").alias("n_readings"),
    )
    q = grouped_quantiles(counts, list(ROLLUP_KEYS), "_v", {"pm25_q25": 0.25, "pm25_median": 0.5, "pm25_q75": 0.75}, count="_n")
    return simple.join(q, list(ROLLUP_KEYS)).select(
        *ROLLUP_KEYS, "pm25_avg", "pm25_min", "pm25_q25", "pm25_median", "pm25_q75", "pm25_max", "coverage", "n_readings"
    )


def payload_completeness(days: DataFrame, start=None, end=None,
                         threshold: float = config.MIN_PAYLOAD_COMPLETENESS) -> DataFrame:
    """Per (city, sensor): days found vs days in [start, end] (inclusive).

    Without explicit bounds the span of the data is used (one scalar
    aggregate).  ``admitted`` is completeness >= threshold.
    """
    if start is None or end is None:
        span = days.select((F.datediff(F.max("date"), F.min("date")) + 1).cast("long")).scalar()
    else:
        span = (F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1).cast("long")
        days = days.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return (
        days.groupBy("city", "sensor_id")
        .agg(F.count(F.lit(1)).alias("found_days"))
        .withColumn("expected_days", span)
        .withColumn("completeness", F.col("found_days") / F.col("expected_days"))
        .withColumn("admitted", F.col("completeness") >= threshold)
    )


def admit_payload(days: DataFrame, start=None, end=None, threshold: float = config.MIN_PAYLOAD_COMPLETENESS) -> DataFrame:
    """Rows of admitted sensors only (semi join on the admission table)."""
    ok = payload_completeness(days, start, end, threshold).filter("admitted").select("city", "sensor_id")
    return days.join(ok, ["city", "sensor_id"], "left_semi")


def missing_dates(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """(city, date) pairs expected but not stored yet — the ingestion work list."""
    return expected.select("city", "date").join(stored.select("city", "date"), ["city", "date"], "left_anti")



def completeness_report(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Per city: days expected, days held, complete flag."""
    held = stored.select("city", "date", F.lit(1).alias("_h"))
    return (
        expected.select("city", "date")
        .join(held, ["city", "date"], "left")
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("days_expected"), F.count("_h").alias("days_held"))
        .withColumn("complete", F.col("days_expected") == F.col("days_held"))
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; no frame, or not one row in all of them, is an error.

    The probe for a row reads sources one after another until one has a row.
    """
    if not any(not df.limit(1).isEmpty() for df in frames):
        raise ValueError("no data in any source")
    return reduce(lambda a, b: a.unionByName(b), frames)
