"""Exploratory statistics over daily series.

Aggregates are single ``groupBy`` passes with map-side partial aggregation.
Series-ordered statistics (rolling sweep, ACF) use one window specification
partitioned by the series key; a partition is one series of daily values.
Only PACF leaves the JVM: it runs Durbin-Levinson on the 61 ACF numbers of
each series in ``applyInPandas`` — the heavy part (the autocovariances over
the full history) stays in Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from .. import functions as fx
from .quantiles import sketched_quantiles
from .series import SERIES, series_window


def skew_by_city(df: DataFrame, col: str = "pm25_avg", key: str = SERIES) -> DataFrame:
    """Bias-adjusted skewness of the raw and of the log1p values per series."""
    return df.groupBy(key).agg(
        fx.adjusted_skewness(F.col(col)).alias("skew"),
        fx.adjusted_skewness(F.log1p(col)).alias("skew_log1p"),
    )


def kurtosis_by_city(df: DataFrame, col: str = "pm25_avg", key: str = SERIES) -> DataFrame:
    """Population (biased) excess kurtosis per series."""
    return df.groupBy(key).agg(F.kurtosis(col).alias("kurtosis"))


def peak_day(df: DataFrame, col: str = "pm25_avg", key: str = SERIES) -> DataFrame:
    """Date of each series' maximum; ties resolve to the earliest date."""
    best = F.max(F.struct(F.col(col).alias("v"), (-F.unix_date("date")).alias("nd")))
    return df.groupBy(key).agg(best.alias("_b")).select(
        key,
        F.col("_b.v").alias("peak_value"),
        F.date_from_unix_date(-F.col("_b.nd")).alias("peak_date"),
    )


def value_histogram(
    df: DataFrame, col: str = "pm25_avg", lo: float = 0.0, hi: float = 100.0, buckets: int = 20,
    key: str = SERIES, log: bool = False,
) -> DataFrame:
    """Counts per (series, bucket) of ``width_bucket(value, lo, hi, buckets)``.

    Bucket 0 holds values below ``lo`` and ``buckets + 1`` values at or
    above ``hi``.  With ``log`` the values are log1p-transformed first.
    """
    v = F.log1p(col) if log else F.col(col)
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(key, F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(buckets)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_stats(df: DataFrame, group_cols, col: str = "pm25_avg") -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per group.

    Two passes: exact quartiles per group (``sketched_quantiles``: no group is
    held in one task), then a join back to the values for the whiskers and
    outliers.  The quartile table has one row per group; the planner
    broadcasts it when small.
    """
    if isinstance(group_cols, str):
        group_cols = [group_cols]
    quartiles = sketched_quantiles(df, list(group_cols), col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = df.groupBy(*group_cols).agg(F.count(col).alias("n")).join(quartiles, list(group_cols), "left").withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    v = F.col(col)
    inside = (v >= lo_fence) & (v <= hi_fence)
    w = df.select(*group_cols, col).join(q, list(group_cols)).groupBy(*group_cols).agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return q.join(w, list(group_cols))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Summary per column (count, mean, std, min, quartiles, max), long format.

    Moments: one aggregation pass over the wide table, unpivoted with
    ``stack``.  Quartiles: exact, from ``sketched_quantiles`` over the
    (column, value) long form, whose counts are stored once: no column is
    ordered in one task, however its values are spread.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    parts = []
    for c in cols:
        parts += [f"'{c}'", f"`{c}__count`", f"`{c}__mean`", f"`{c}__std`", f"`{c}__min`", f"`{c}__max`"]
    moments = df.agg(*aggs).selectExpr(
        f"stack({len(cols)}, {', '.join(parts)}) AS (`column`, `count`, mean, std, `min`, `max`)"
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("kv")).select("kv.column", "kv.value")
    q = sketched_quantiles(long, ["column"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return moments.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "median", "q75", "max"
    )


def rolling_sweep(df: DataFrame, col: str = "pm25_avg", kmin: int = 2, kmax: int = 30, key: str = SERIES) -> DataFrame:
    """For window sizes k in [kmin, kmax]: std of the rolling mean and of the
    rolling std of each series (full windows only).

    All 2·(kmax-kmin+1) rolling columns share one (series, date) window spec
    → one exchange, one sort, one Window node; one aggregation follows and
    ``stack`` unpivots the result to (series, k, ...).
    """
    base = series_window(key)
    cols = []
    for k in range(kmin, kmax + 1):
        w = base.rowsBetween(-(k - 1), 0)
        full = F.count(col).over(w) == k
        cols += [
            F.when(full, F.avg(col).over(w)).alias(f"m{k}"),
            F.when(full, F.stddev_samp(col).over(w)).alias(f"s{k}"),
        ]
    rolled = df.select(key, *cols)
    aggs = []
    for k in range(kmin, kmax + 1):
        aggs += [F.stddev_samp(f"m{k}").alias(f"m{k}"), F.stddev_samp(f"s{k}").alias(f"s{k}")]
    wide = rolled.groupBy(key).agg(*aggs)
    n = kmax - kmin + 1
    parts = ", ".join(f"{k}, m{k}, s{k}" for k in range(kmin, kmax + 1))
    return wide.selectExpr(key, f"stack({n}, {parts}) AS (k, std_rolling_mean, std_rolling_std)").withColumn(
        "k", F.col("k").cast("long")
    )


def acf(df: DataFrame, col: str = "pm25_avg", nlags: int = config.ACF_LAGS, key: str = SERIES) -> DataFrame:
    """Autocorrelation of each series over its observed rows (gaps collapsed).

    r_k = Σ (x_t - m)(x_{t+k} - m) / Σ (x_t - m)², biased estimator, k = 1..nlags,
    with the Bartlett 95% band half-width z·sqrt((1 + 2 Σ_{j<k} r_j²) / n).

    Plan: one window (series, date) centres the values with the series mean
    and emits the ``nlags`` lagged products in the same sort order; one
    aggregation sums them; ``stack`` unpivots.  No self-join.
    """
    w_all = series_window(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centred = df.select(key, "date", (F.col(col) - F.avg(col).over(w_all)).alias("_d"))
    w = series_window(key)
    prods = [(F.col("_d") * F.lag("_d", k).over(w)).alias(f"p{k}") for k in range(1, nlags + 1)]
    lagged = centred.select(key, (F.col("_d") * F.col("_d")).alias("p0"), *prods)
    sums = lagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"p{k}").alias(f"p{k}") for k in range(0, nlags + 1)]
    )
    parts = ", ".join(f"{k}, p{k} / p0" for k in range(1, nlags + 1))
    long = sums.selectExpr(key, "n", f"stack({nlags}, {parts}) AS (lag, acf)").withColumn("lag", F.col("lag").cast("long"))
    cum = Window.partitionBy(key).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.col("acf") * F.col("acf")).over(cum), F.lit(0.0))
    return long.select(
        key,
        "lag",
        "acf",
        (F.lit(config.Z_975) * F.sqrt((1 + 2 * prior) / F.col("n"))).alias("band"),
    )


_PACF_SCHEMA = T.StructType(
    [
        T.StructField(SERIES, T.StringType()),
        T.StructField("lag", T.LongType()),
        T.StructField("pacf", T.DoubleType()),
    ]
)


def _durbin_levinson(pdf: pd.DataFrame) -> pd.DataFrame:
    """PACF from the autocorrelations of one series (Yule-Walker, biased acov)."""
    pdf = pdf.sort_values("lag")
    r = np.concatenate([[1.0], pdf["acf"].to_numpy(dtype=float)])
    nl = len(r) - 1
    out = np.full(nl, np.nan)
    phi = np.zeros(nl + 1)
    v = 1.0
    for k in range(1, nl + 1):
        if v <= 0:
            break
        a = (r[k] - np.dot(phi[1:k], r[1:k][::-1])) / v
        new = phi.copy()
        new[k] = a
        new[1:k] = phi[1:k] - a * phi[1:k][::-1]
        phi = new
        v = v * (1 - a * a)
        out[k - 1] = a
    return pd.DataFrame({SERIES: pdf[SERIES].iloc[0], "lag": np.arange(1, nl + 1, dtype="int64"), "pacf": out})


def pacf(acf_df: DataFrame, key: str = SERIES) -> DataFrame:
    """Partial autocorrelation per series from an ``acf`` result.

    Each group is the ``nlags`` numbers of one series, so the Python side
    handles a fixed, tiny amount of data per series.
    """
    src = acf_df.select(F.col(key).alias(SERIES), "lag", "acf")
    return src.groupBy(SERIES).applyInPandas(_durbin_levinson, _PACF_SCHEMA)


def rmse_col(y_true, y_pred) -> Column:
    """Aggregate: sqrt(mean((y - ŷ)²))."""
    yt = F.col(y_true) if isinstance(y_true, str) else y_true
    yp = F.col(y_pred) if isinstance(y_pred, str) else y_pred
    return F.sqrt(F.avg(F.pow(yt - yp, 2)))


def rmsle_col(y_true, y_pred) -> Column:
    yt = F.col(y_true) if isinstance(y_true, str) else y_true
    yp = F.col(y_pred) if isinstance(y_pred, str) else y_pred
    return rmse_col(F.log1p(yt), F.log1p(yp))
