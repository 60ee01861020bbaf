"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- dates ---------------------------------------------------------------

def local_date(local_ts) -> Column:
    """Calendar day of a local ISO timestamp string: its first 10 characters.

    The zone suffix is ignored on purpose, so the session zone never matters.
    """
    return F.to_date(F.substring(_c(local_ts), 1, 10), "yyyy-MM-dd")


def day_of_week(date) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(date))


def is_weekend(date) -> Column:
    return (day_of_week(date) >= 5).cast("int")


def days_in_month(date) -> Column:
    return F.dayofmonth(F.last_day(_c(date)))


def month_cos(date) -> Column:
    return F.cos(F.month(_c(date)) * 2 * math.pi / 12)


def month_sin(date) -> Column:
    return F.sin(F.month(_c(date)) * 2 * math.pi / 12)


def warmup_start(batch_start, days: int = config.WARMUP_DAYS) -> Column:
    return F.date_sub(_c(batch_start), days)


# --- values --------------------------------------------------------------

def log1p(x) -> Column:
    return F.log1p(_c(x))


def expm1(x) -> Column:
    return F.expm1(_c(x))


def temp_gradient(temp_max="temp_max", temp_min="temp_min") -> Column:
    return _c(temp_max) - _c(temp_min)


def clip_lower(x, lower: float = 0.001) -> Column:
    """max(x, lower); null stays null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(x, F.lit(lower)))


def relative_improvement(challenger, champion) -> Column:
    """100 * (1 - challenger / champion); null when champion is null or 0."""
    champ = _c(champion)
    return F.when(champ.isNull() | (champ == 0), F.lit(None).cast("double")).otherwise(
        100 * (1 - F.try_divide(_c(challenger), champ))
    )



def round_double(x, bits: int = config.ROUND_BITS) -> Column:
    """Round to the nearest multiple of 2^-bits (ties upward).

    Scaling by a power of two is exact in IEEE arithmetic, so two engines
    that start from the same double get the same bits; and decimal data
    (prices, averages of them) never lands exactly on a binary tie, so
    last-ulp differences between summation orders almost never change the
    result.
    """
    m = float(2**bits)
    return F.floor(_c(x) * m + 0.5) / m


# --- monitoring predicates ----------------------------------------------

def drift_flag(score_new, score_ref, margin: float = config.DRIFT_THRESHOLD) -> Column:
    """Drift when the new score is at least ref * (1 + margin%) (inclusive)."""
    return _c(score_new) >= _c(score_ref) * (1 + margin / 100)


def promotion_flag(score_new, score_old, margin: float = config.IMPROVEMENT_THRESHOLD) -> Column:
    """Promote when new <= (1 - margin%) * old (inclusive)."""
    return _c(score_new) <= (1 - margin / 100) * _c(score_old)


def adjusted_skewness(x) -> Column:
    """Bias-adjusted sample skewness (aggregate).

    Spark's ``skewness`` is the population moment ratio; the sample form
    multiplies by sqrt(n(n-1))/(n-2).  Null for n < 3.
    """
    n = F.count(_c(x)).cast("double")
    return F.when(n >= 3, F.skewness(_c(x)) * F.sqrt(n * (n - 1)) / (n - 2))
