"""Window operators over daily series, keyed by ``city`` and ordered by ``date``.

All operators partition by the series key, so a window partition holds one
series: after sensor averaging that is one row per calendar day, bounded by
the length of the history rather than by the raw data volume.  Operators
that share the ``(city, date)`` specification are evaluated by Spark in one
Window node after one exchange and one sort; see ``add_features``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config

SERIES = "city"
ORDER = "date"


def series_window(key: str = SERIES, order: str = ORDER) -> Window:
    return Window.partitionBy(key).orderBy(order)


# --- checks --------------------------------------------------------------

def max_step(df: DataFrame, key: str = SERIES) -> DataFrame:
    """One row: largest day step inside any series and the row count."""
    w = series_window(key)
    steps = df.select(F.datediff(ORDER, F.lag(ORDER).over(w)).alias("step"))
    return steps.agg(F.max("step").cast("long").alias("max_step"), F.count(F.lit(1)).alias("n_rows"))


def assert_contiguous(df: DataFrame, key: str = SERIES) -> int:
    """Raise if a series skips a day (step > 1) or if ``df`` is empty.

    Duplicated days (step 0) pass.  One Spark job; returns the row count.
    """
    row = max_step(df, key).first()
    if row["n_rows"] == 0:
        raise ValueError("weather DataFrame is empty")
    if row["max_step"] is not None and row["max_step"] > 1:
        raise ValueError("missing days detected in weather DataFrame")
    return row["n_rows"]


# --- gap repair ------------------------------------------------------------

def contiguity_guard(step: Column) -> Column:
    """Row predicate that is always true but fails the job on a step > 1 day.

    Used as a filter so the check rides along in the job that computes the
    result (no separate Spark job) and cannot be pruned away.
    """
    bad = F.when(step > 1, F.raise_error(F.lit("missing days detected in weather DataFrame")))
    return F.coalesce(bad.cast("boolean"), F.lit(True))


def impute_gaps(
    df: DataFrame, col: str = "pm25_avg", limit: int = config.LIMIT, key: str = SERIES, check_contiguous: bool = False
) -> DataFrame:
    """Linear interpolation inside each series, at most ``limit`` values per gap.

    Position is the row number in date order (rows of one day: by value, unknown
    ones last), so duplicated days are rows of their own and an absent day is no
    gap.  Only the first ``limit`` missing days of
    an inner gap are filled, forward from the last known value; gaps at the
    series edges stay missing.  ``[1,_,_,_,5]`` with limit 1 gives
    ``[1,2,_,_,5]``.

    Previous known value: growing frame (unbounded preceding .. 1 preceding).
    Next known value: the same growing frame over the reversed order, which
    keeps the cost linear in the series length.

    ``check_contiguous`` evaluates the day step in the same Window node and
    fails the job when a series skips a day.
    """
    pos = F.col("_pos")
    known_pos = F.when(F.col(col).isNotNull(), pos)
    order = Window.partitionBy(key).orderBy(F.col(ORDER).asc(), F.col(col).asc_nulls_last())
    fwd = order.rowsBetween(Window.unboundedPreceding, -1)
    bwd = Window.partitionBy(key).orderBy(pos.desc()).rowsBetween(Window.unboundedPreceding, -1)
    extra = []
    if check_contiguous:
        extra = [F.datediff(ORDER, F.lag(ORDER).over(series_window(key))).alias("_step")]
    tagged = df.select("*", *extra, F.row_number().over(order).alias("_pos")).select(
        "*",
        F.last(col, ignorenulls=True).over(fwd).alias("_pv"),
        F.last(known_pos, ignorenulls=True).over(fwd).alias("_pp"),
        F.last(col, ignorenulls=True).over(bwd).alias("_nv"),
        F.last(known_pos, ignorenulls=True).over(bwd).alias("_np"),
    )
    if check_contiguous:
        tagged = tagged.filter(contiguity_guard(F.col("_step")))
    p = pos
    fill = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * ((p - F.col("_pp")) / (F.col("_np") - F.col("_pp")))
    can = F.col(col).isNull() & F.col("_nv").isNotNull() & F.col("_pv").isNotNull() & ((p - F.col("_pp")) <= limit)
    # one projection restores the input columns with the repaired value
    return tagged.select(*[(F.when(can, fill).otherwise(F.col(c)) if c == col else F.col(c)).alias(c) for c in df.columns])


# --- target, lags, rolling --------------------------------------------------

def target_col(col: str = "pm25_avg", horizon: int = config.HORIZON, key: str = SERIES) -> Column:
    """Value ``horizon`` rows ahead in the same series."""
    return F.lead(col, horizon).over(series_window(key))


def generate_target(df: DataFrame, horizon: int = config.HORIZON, col: str = "pm25_avg", key: str = SERIES) -> DataFrame:
    return df.withColumn("target", target_col(col, horizon, key))


def lag_col(col: str, shift: int, key: str = SERIES) -> Column:
    """Row shift inside a series; shift 0 is the value itself."""
    if shift == 0:
        return F.col(col)
    return F.lag(col, shift).over(series_window(key))


def lag_columns(shifts: dict, key: str = SERIES) -> list[Column]:
    """``{out: (in, shift)}`` → list of aliased lag columns (one window)."""
    return [lag_col(src, k, key).alias(out) for out, (src, k) in shifts.items()]



def lag_average_col(col: str = "pm25_avg", shifts=config.LAG_AVG_SHIFTS, key: str = SERIES) -> Column:
    """Mean of the given shifts; null if any of them is null."""
    terms = [lag_col(col, k, key) for k in shifts]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / len(shifts)


def rolling_std_col(col: str = "pm25_avg", window: int = config.WEEK_STD_WINDOW, key: str = SERIES) -> Column:
    """Sample std over the last ``window`` rows, null unless all are present."""
    w = series_window(key).rowsBetween(-(window - 1), 0)
    return F.when(F.count(col).over(w) == window, F.stddev_samp(col).over(w))


def rolling_mean_col(col: str = "pm25_avg", window: int = 30, key: str = SERIES) -> Column:
    """Mean over the last ``window`` rows, null unless all are present."""
    w = series_window(key).rowsBetween(-(window - 1), 0)
    return F.when(F.count(col).over(w) == window, F.avg(col).over(w))


def rolling_mean(df: DataFrame, col: str = "pm25_avg", window: int = 30, key: str = SERIES) -> DataFrame:
    return df.withColumn(f"rolling_mean_{window}", rolling_mean_col(col, window, key))


def week_std(df: DataFrame, col: str = "pm25_avg", window: int = config.WEEK_STD_WINDOW) -> DataFrame:
    return df.withColumn("week_std", rolling_std_col(col, window))


def lag_avg_14(df: DataFrame, col: str = "pm25_avg") -> DataFrame:
    return df.withColumn("lag_avg_14", lag_average_col(col))
