"""Sensor quality: value cleaning, gap and coverage scoring, exclusion,
per-series averaging.

Partitioning notes (at scale):

* every per-sensor window runs over *sensor-day* rows, at most one row per
  calendar day and sensor, so a window partition is bounded by the calendar
  (about 365 rows per year of history) no matter how many raw readings exist;
* exact quantiles (``percentile``) therefore hold at most a sensor's days in
  an aggregation buffer;
* flagged-sensor sets have at most one row per sensor; the anti join that
  applies them is planned by Spark, which broadcasts the set when its
  measured size is under the broadcast threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def require_columns(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"column(s) {missing} missing from DataFrame")


# --- value cleaning ------------------------------------------------------

def clean_positive(df: DataFrame, col: str = "pm25_avg") -> DataFrame:
    """Keep rows whose ``col`` is > 0 (null and non-positive rows go)."""
    require_columns(df, col)
    return df.filter(F.col(col) > 0)


def clean_report(df: DataFrame, col: str = "pm25_avg") -> DataFrame:
    """One-row report: total rows, non-positive rows and their percentage."""
    require_columns(df, col)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(col) <= 0).alias("non_positive_rows"),
        F.try_divide(100.0 * F.count_if(F.col(col) <= 0), F.count(F.lit(1))).alias("non_positive_pct"),
    )


def negative_share(df: DataFrame, col: str = "pm25_avg", inclusive: bool = False) -> DataFrame:
    """Per (city, sensor): readings, readings < 0 (<= 0 if inclusive), percent."""
    cond = F.col(col) <= 0 if inclusive else F.col(col) < 0
    return (
        df.groupBy("city", "sensor_id")
        .agg(F.count(col).alias("total"), F.count_if(cond).alias("neg_values"))
        .withColumn("pct_neg", F.col("neg_values") / F.col("total") * 100)
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column (selected later or not)."""
    return df.dropna(how="any")


def drop_helper_cols(df: DataFrame, cols=("pm25_avg",)) -> DataFrame:
    return df.drop(*cols)


# --- gaps ---------------------------------------------------------------

def sensor_day_gaps(df: DataFrame) -> DataFrame:
    """Adds ``delta``: days since the same sensor's previous reading."""
    w = Window.partitionBy("sensor_id").orderBy("date")
    return df.withColumn("delta", F.datediff("date", F.lag("date").over(w)).cast("long"))


def gap_events(df: DataFrame) -> DataFrame:
    """Gaps (delta > 1): city, sensor, day the gap ends, its length in days."""
    return (
        sensor_day_gaps(df.select("city", "sensor_id", "date"))
        .filter(F.col("delta") > 1)
        .select("city", "sensor_id", F.col("date").alias("gap_end"), F.col("delta").alias("gap_days"))
    )


def sensor_gap_stats(df: DataFrame) -> DataFrame:
    """Per (city, sensor) over its gaps: count, max, median, q75 (linear)."""
    g = gap_events(df)
    return g.groupBy("city", "sensor_id").agg(
        F.count(F.lit(1)).alias("gap_count"),
        F.max("gap_days").alias("gap_max"),
        F.percentile(F.col("gap_days").cast("double"), 0.5).alias("gap_median"),
        F.percentile(F.col("gap_days").cast("double"), 0.75).alias("gap_q75"),
    )


def flag_gap_sensors(df: DataFrame, max_gap: int = config.MAX_GAP, max_q: float = config.MAX_Q) -> DataFrame:
    """Sensors whose longest gap >= max_gap or gap q75 >= max_q.

    A sensor without any gap > 1 day is never flagged.
    """
    s = sensor_gap_stats(df)
    return s.filter((F.col("gap_max") >= max_gap) | (F.col("gap_q75") >= max_q)).select("sensor_id")


# --- coverage -----------------------------------------------------------

def monthly_coverage(df: DataFrame, min_coverage_pct: float = config.MIN_COVERAGE_PCT) -> DataFrame:
    """Per (city, sensor, calendar month): readings, days in month, coverage %.

    Counts rows (not distinct days); months without any reading do not
    appear; partial edge months count against the full month length.
    ``month`` is the month's last day.
    """
    m = df.groupBy("city", "sensor_id", F.last_day("date").alias("month")).agg(
        F.count(F.lit(1)).alias("nb_readings")
    )
    return (
        m.withColumn("days_in_month", F.dayofmonth("month").cast("long"))
        .withColumn("coverage_pct", F.col("nb_readings") / F.col("days_in_month") * 100)
        .withColumn("bad_month", (F.col("coverage_pct") < min_coverage_pct).cast("int"))
    )


def flag_coverage_sensors(
    df: DataFrame,
    min_coverage_pct: float = config.MIN_COVERAGE_PCT,
    min_bad_month_pct: float = config.MIN_BAD_MONTH_PCT,
) -> DataFrame:
    """Sensors whose share of bad months is strictly above the ratio."""
    return (
        monthly_coverage(df, min_coverage_pct)
        .groupBy("city", "sensor_id")
        .agg(F.avg("bad_month").alias("bad_month_pct"))
        .filter(F.col("bad_month_pct") > min_bad_month_pct)
        .select("sensor_id")
    )


def flag_union(*flag_sets: DataFrame) -> DataFrame:
    """Distinct union of flagged sensor-id sets."""
    out = flag_sets[0].select("sensor_id")
    for s in flag_sets[1:]:
        out = out.union(s.select("sensor_id"))
    return out.distinct()


def exclude_sensors(df: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows of sensors not in ``flagged`` (by sensor id alone)."""
    return df.join(flagged.select("sensor_id"), "sensor_id", "left_anti").select(*df.columns)


def flagged_sensors(
    df: DataFrame,
    max_gap: int = config.MAX_GAP,
    max_q: float = config.MAX_Q,
    min_coverage_pct: float = config.MIN_COVERAGE_PCT,
    min_bad_month_pct: float = config.MIN_BAD_MONTH_PCT,
) -> DataFrame:
    return flag_union(
        flag_gap_sensors(df, max_gap, max_q),
        flag_coverage_sensors(df, min_coverage_pct, min_bad_month_pct),
    )


def _sensor_window_cols():
    """Window expressions behind the one-pass sensor filter.

    Gaps come from consecutive days of a sensor; gap statistics are per
    (city, sensor); monthly coverage per (city, sensor, month).  Every
    window is partitioned by a superset of ``sensor_id``, so one hash
    exchange on ``sensor_id`` serves them all.
    """
    w_s = Window.partitionBy("sensor_id").orderBy("date")
    w_cs = Window.partitionBy("city", "sensor_id")
    w_csm = Window.partitionBy("city", "sensor_id", "_month")
    stage1 = [
        F.datediff("date", F.lag("date").over(w_s)).alias("_delta"),
        F.last_day("date").alias("_month"),
    ]
    stage2 = [
        F.count(F.lit(1)).over(w_csm).alias("_nb"),
        F.row_number().over(w_csm.orderBy("date")).alias("_rn"),
    ]
    return stage1, stage2


def filter_sensors(
    df: DataFrame,
    max_gap: int = config.MAX_GAP,
    max_q: float = config.MAX_Q,
    min_coverage_pct: float = config.MIN_COVERAGE_PCT,
    min_bad_month_pct: float = config.MIN_BAD_MONTH_PCT,
) -> DataFrame:
    """Remove every sensor flagged by the gap rule or the coverage rule.

    One pass: the sensor-day rows are hash-partitioned on ``sensor_id``
    once; gap statistics, monthly coverage and the flag are window
    aggregates inside that partitioning (each window partition is one
    sensor's days, bounded by the calendar), and a filter drops the flagged
    sensors.  The input is read once — no separate flag branches and no
    anti join.  ``flag_gap_sensors`` / ``flag_coverage_sensors`` give the
    same sets as tables.
    """
    stage1, stage2 = _sensor_window_cols()
    cols = df.columns
    a = df.select("*", *stage1).select("*", *stage2)
    w_cs = Window.partitionBy("city", "sensor_id")
    first = (F.col("_rn") == 1).cast("int")
    bad = ((F.col("_nb") / F.dayofmonth("_month") * 100) < min_coverage_pct).cast("int")
    gap = F.when(F.col("_delta") > 1, F.col("_delta"))
    # gap statistics and the bad-month ratio share the (city, sensor) window: one Window node
    gmax = F.max(gap).over(w_cs)
    gq75 = F.percentile(gap.cast("double"), 0.75).over(w_cs)
    ratio = F.sum(bad * first).over(w_cs) / F.sum(first).over(w_cs)
    flag_cs = (
        F.coalesce(gmax >= max_gap, F.lit(False))
        | F.coalesce(gq75 >= max_q, F.lit(False))
        | (ratio > min_bad_month_pct)
    )
    b = a.withColumn("_f", flag_cs.cast("int"))
    flagged = F.max("_f").over(Window.partitionBy("sensor_id"))
    return b.withColumn("_fs", flagged).filter(F.col("_fs") == 0).select(*cols)


def filter_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct sensors before/after the filter and removed (one row)."""
    n_after = after.agg(F.count_distinct("sensor_id")).scalar()
    return (
        before.agg(F.count_distinct("sensor_id").alias("sensors_before"))
        .withColumn("sensors_after", n_after)
        .withColumn("sensors_removed", F.col("sensors_before") - F.col("sensors_after"))
    )


# --- averaging ----------------------------------------------------------

def average_sensors(df: DataFrame, cols=("pm25_avg",)) -> DataFrame:
    """Unweighted mean across sensors per (city, date) of each value column."""
    if isinstance(cols, str):
        cols = (cols,)
    return df.groupBy("city", "date").agg(*[F.avg(c).alias(c) for c in cols])


def match_rate(merged: DataFrame, col: str = "pm25_avg") -> DataFrame:
    """Matched days / all days after the merge (one row)."""
    return merged.agg(
        F.count(col).alias("matched_days"),
        F.count(F.lit(1)).alias("total_days"),
        (F.count(col) / F.count(F.lit(1))).alias("match_rate"),
    )

