import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogline.operators import series
from smogline.plans import preprocess as pp

from .conftest import series_df


def values(df, col="pm25_avg"):
    return [r[col] for r in df.orderBy("city", "date").collect()]


def approx_list(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if y is None:
            assert x is None
        else:
            assert x == pytest.approx(y)


def test_imputer_limit_1_fills_first_day_of_each_inner_gap(spark):
    df = series_df(spark, [None, 1, None, None, None, 5, None, 7, None, None])
    approx_list(values(series.impute_gaps(df, limit=1)), [None, 1, 2, None, None, 5, 6, 7, None, None])


def test_imputer_limit_2(spark):
    df = series_df(spark, [None, 1, None, None, None, 5, None, 7, None, None])
    approx_list(values(series.impute_gaps(df, limit=2)), [None, 1, 2, 3, None, 5, 6, 7, None, None])


def test_imputer_matches_pandas_on_random_series(spark):
    rng = np.random.default_rng(7)
    vals = rng.uniform(1, 50, 200)
    vals[rng.random(200) < 0.35] = np.nan
    expected = pd.Series(vals).interpolate(method="linear", limit=1, limit_area="inside").tolist()
    df = series_df(spark, [None if math.isnan(v) else v for v in vals])
    got = values(series.impute_gaps(df, limit=1))
    approx_list(got, [None if math.isnan(v) else v for v in expected])


def test_imputer_leaves_known_values_and_is_per_series(spark):
    a = series_df(spark, [1, None, 3], city="A")
    b = series_df(spark, [None, 10, None], city="B")
    out = series.impute_gaps(a.unionByName(b))
    rows = {(r.city, str(r.date)): r.pm25_avg for r in out.collect()}
    assert rows[("A", "2024-01-02")] == pytest.approx(2.0)
    assert rows[("B", "2024-01-01")] is None and rows[("B", "2024-01-03")] is None
    assert rows[("B", "2024-01-02")] == 10.0


def test_week_std_needs_seven_values(spark):
    vals = [1, 2, 3, None, 5, 6, 7, 8, 9, 10, 11]
    df = series_df(spark, vals)
    got = values(df.withColumn("w", series.rolling_std_col("pm25_avg")), "w")
    expected = pd.Series(vals, dtype=float).rolling(7).std().tolist()
    approx_list(got, [None if math.isnan(v) else v for v in expected])
    assert got[-1] == pytest.approx(2.1602468994692887)


def test_lags_target_and_lag_average(spark):
    vals = list(range(1, 21))
    df = series_df(spark, vals)
    out = df.select(
        "city", "date", "pm25_avg",
        series.target_col().alias("target"),
        *series.lag_columns({"lag_1": ("pm25_avg", 0), "lag_7": ("pm25_avg", 6)}),
        series.lag_average_col().alias("lag_avg_14"),
    ).orderBy("date").collect()
    assert out[0].target == 2 and out[-1].target is None
    assert out[6].lag_7 == 1 and out[5].lag_7 is None
    assert out[0].lag_1 == 1
    assert out[13].lag_avg_14 is None
    assert out[14].lag_avg_14 == pytest.approx((3 + 2 + 1) / 3)


def test_lag_average_propagates_null(spark):
    vals = list(range(1, 21))
    vals[2] = None
    out = values(series.lag_avg_14(series_df(spark, vals)), "lag_avg_14")
    assert out[15] is None and out[16] is None and out[14] is None  # shift 12..14 hit index 2
    assert out[17] == pytest.approx((6 + 5 + 4) / 3)


def test_assert_contiguous(spark):
    ok = series_df(spark, [1, 2, 3])
    assert series.assert_contiguous(ok) == 3
    gap = series_df(spark, [1, 2]).unionByName(series_df(spark, [5], start="2024-01-04"))
    with pytest.raises(ValueError):
        series.assert_contiguous(gap)
    dup = ok.unionByName(series_df(spark, [9], start="2024-01-02"))
    assert series.assert_contiguous(dup) == 4


def test_calendar_features(spark):
    df = series_df(spark, [1] * 7, start="2024-01-01")  # Monday
    out = df.select("date", *pp.calendar_columns()).orderBy("date").collect()
    assert [r.dow for r in out] == [0, 1, 2, 3, 4, 5, 6]
    assert [r.is_weekend for r in out] == [0, 0, 0, 0, 0, 1, 1]
    assert out[0].month_cos == pytest.approx(math.cos(2 * math.pi / 12))


def test_feature_engineering_rejects_unknown_approach(spark):
    df = series_df(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        pp.feature_engineering(df.withColumn("temp_max", F.lit(1.0)).withColumn("temp_min", F.lit(0.0)), "nope")


def test_filter_columns_arguments(spark):
    df = series_df(spark, [1])
    with pytest.raises(ValueError):
        pp.filter_columns(df)
    with pytest.raises(ValueError):
        pp.filter_columns(df, keep=["city"], remove=["city"])
    assert pp.filter_columns(df, keep=["date", "city"]).columns == ["date", "city"]
    assert pp.filter_columns(df, remove=["date"]).columns == ["city", "pm25_avg"]


def test_in_plan_contiguity_guard_fails_the_job(spark):
    gap = series_df(spark, [1, None, 3]).unionByName(series_df(spark, [5], start="2024-01-06"))
    with pytest.raises(Exception, match="missing days"):
        series.impute_gaps(gap, check_contiguous=True).collect()
    ok = series_df(spark, [1, None, 3])
    assert len(series.impute_gaps(ok, check_contiguous=True).collect()) == 3


def test_imputer_counts_rows_not_days(spark):
    import datetime as dt

    from smogline.operators import series

    d = dt.date(2024, 1, 1)
    twice = spark.createDataFrame([("A", d, 2.0), ("A", d, None), ("A", d + dt.timedelta(1), 4.0)], "city string, date date, pm25_avg double")
    assert sorted(r.pm25_avg for r in series.impute_gaps(twice).collect()) == [2.0, 3.0, 4.0]
    absent = spark.createDataFrame([("A", d, 2.0), ("A", d + dt.timedelta(5), None), ("A", d + dt.timedelta(6), 4.0)], "city string, date date, pm25_avg double")
    assert sorted(r.pm25_avg for r in series.impute_gaps(absent).collect()) == [2.0, 3.0, 4.0]


def test_average_baseline_skips_nulls(spark):
    from smogline.plans.forecast import baseline_col

    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (1.0, 2.0, 6.0)], "lag_1 double, lag_2 double, lag_3 double")
    assert [r.p for r in df.select(baseline_col("average").alias("p")).collect()] == [2.0, None, 3.0]
