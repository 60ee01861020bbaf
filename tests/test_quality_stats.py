import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogline import functions as fx
from smogline.operators import quality, stats
from smogline.operators.quantiles import SLICES, grouped_quantiles, sketched_quantiles, sketched_slices


def sensor_days(spark, sensor, dates, city="C", value=1.0):
    rows = [(city, sensor, dt.date.fromisoformat(d) if isinstance(d, str) else d, value) for d in dates]
    return spark.createDataFrame(rows, "city string, sensor_id long, date date, pm25_avg double")


def days_with_gaps(start, gaps):
    """Dates starting at ``start`` whose successive deltas are ``gaps``."""
    d = dt.date.fromisoformat(start)
    out = [d]
    for g in gaps:
        d = d + dt.timedelta(days=g)
        out.append(d)
    return out


def test_gap_q75_and_flag(spark):
    df = sensor_days(spark, 1, days_with_gaps("2024-01-01", [2, 3, 10, 20]))
    st = quality.sensor_gap_stats(df).first()
    assert st.gap_q75 == pytest.approx(12.5) and st.gap_max == 20 and st.gap_count == 4
    assert [r.sensor_id for r in quality.flag_gap_sensors(df).collect()] == [1]


def test_max_gap_boundary_is_inclusive(spark):
    a = sensor_days(spark, 1, days_with_gaps("2024-01-01", [30, 1, 1, 1, 1, 1, 1, 1]))
    b = sensor_days(spark, 2, days_with_gaps("2024-01-01", [29, 1, 1, 1, 1, 1, 1, 1]))
    flagged = {r.sensor_id for r in quality.flag_gap_sensors(a.unionByName(b), max_gap=30, max_q=100).collect()}
    assert flagged == {1}


def test_sensor_without_gaps_never_flagged(spark):
    df = sensor_days(spark, 3, days_with_gaps("2024-01-01", [1] * 10))
    assert quality.flag_gap_sensors(df).count() == 0


def test_bad_month_ratio_strict_and_silent_month(spark):
    # five observed months, one of them bad (ratio 0.20 → not flagged); one silent month ignored
    dates = []
    for m in (1, 2, 3, 4, 6):
        n = 5 if m == 2 else 28
        dates += [dt.date(2023, m, d) for d in range(1, n + 1)]
    df = sensor_days(spark, 7, dates)
    cov = quality.monthly_coverage(df).orderBy("month").collect()
    assert len(cov) == 5 and sum(r.bad_month for r in cov) == 1
    assert quality.flag_coverage_sensors(df).count() == 0
    assert quality.flag_coverage_sensors(df, min_bad_month_pct=0.19).count() == 1


def test_filter_sensors_excludes_by_id_and_keeps_others(spark):
    bad = sensor_days(spark, 1, days_with_gaps("2024-01-01", [40, 1]))
    good = sensor_days(spark, 2, days_with_gaps("2024-01-01", [1] * 5))
    out = quality.filter_sensors(bad.unionByName(good), min_coverage_pct=0)
    assert {r.sensor_id for r in out.collect()} == {2}


def test_clean_positive(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("a", -2.0), ("a", None)], "city string, pm25_avg double")
    assert quality.clean_positive(df).count() == 1
    with pytest.raises(KeyError):
        quality.clean_positive(df, "nope")
    rep = quality.clean_report(df).first()
    assert rep.total_rows == 4 and rep.non_positive_rows == 2


def test_distribution_stats_against_pandas(spark):
    df = spark.createDataFrame([("x", v) for v in (1.0, 2.0, 3.0, 10.0)], "city string, pm25_avg double")
    sk = stats.skew_by_city(df).first()
    assert sk.skew == pytest.approx(1.763632614803888)
    k = stats.kurtosis_by_city(df).first()
    assert k.kurtosis == pytest.approx(-0.7696, abs=1e-4)
    q = df.agg(F.percentile("pm25_avg", 0.75).alias("q"), F.stddev_samp("pm25_avg").alias("s")).first()
    assert q.q == pytest.approx(4.75) and q.s == pytest.approx(4.08248290463863)


def test_peak_day_tie_takes_earliest(spark):
    rows = [("x", dt.date(2024, 1, d), v) for d, v in ((1, 3.0), (2, 9.0), (3, 9.0), (4, 1.0))]
    df = spark.createDataFrame(rows, "city string, date date, pm25_avg double")
    r = stats.peak_day(df).first()
    assert r.peak_date == dt.date(2024, 1, 2) and r.peak_value == 9.0


def test_box_stats(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("x", float(v)) for v in vals], "city string, pm25_avg double")
    r = stats.box_stats(df, ["city"]).first()
    s = pd.Series(vals, dtype=float)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert r.q1 == q1 and r.q3 == q3 and r.outliers == 1 and r.whisker_high == 8.0 and r.whisker_low == 1.0


def test_acf_and_pacf_against_numpy(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = 0.6 * x[t - 1] + rng.normal()
    rows = [("c", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "city string, date date, pm25_avg double")
    a = stats.acf(df, nlags=10).orderBy("lag").toPandas()
    d = x - x.mean()
    ref = [np.sum(d[k:] * d[:-k]) / np.sum(d * d) for k in range(1, 11)]
    np.testing.assert_allclose(a["acf"], ref, rtol=1e-9)
    var = np.ones(10) / n
    var[1:] *= 1 + 2 * np.cumsum(np.array(ref[:-1]) ** 2)
    np.testing.assert_allclose(a["band"], 1.959963984540054 * np.sqrt(var), rtol=1e-9)
    p = stats.pacf(stats.acf(df, nlags=10)).orderBy("lag").toPandas()
    # Yule-Walker: solve the Toeplitz system for each order
    r = np.concatenate([[1.0], ref])
    exp = []
    for k in range(1, 11):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        exp.append(np.linalg.solve(R, r[1 : k + 1])[-1])
    np.testing.assert_allclose(p["pacf"], exp, rtol=1e-8)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_quantiles_equal_percentile(spark, reuse):
    rng = np.random.default_rng(11)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [("cold", float(v)) for v in rng.normal(size=50)]
    rows += [("ties", 2.0)] * 900 + [("ties", float(v)) for v in range(100)] + [("one", 5.0), ("none", None), (None, 1.0), (None, 4.0)]
    rows += [("odd", v) for v in (float("inf"), float("-inf"), 1.0, 2.0, 3e300)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q9": 0.9}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", probs).collect()}
        ref = {r.k: r for r in df.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert set(got) == {"hot", "cold", "ties", "one", "odd", None}
    for k in got:
        for n in probs:
            assert getattr(got[k], n) == pytest.approx(getattr(ref[k], n), rel=1e-12, nan_ok=True)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    out = df.select(
        fx.relative_improvement("a", "b").alias("ri"), fx.clip_lower(F.col("a") - 5).alias("c"),
        fx.drift_flag(F.lit(1.1), F.lit(1.0)).alias("d"), fx.promotion_flag(F.lit(0.99), F.lit(1.0)).alias("p"),
    ).collect()
    assert out[0].ri == pytest.approx(-100.0) and out[1].ri is None and out[2].ri is None
    assert out[0].c == 0.001 and out[2].c is None
    assert out[0].d is True and out[0].p is True


def test_local_date_ignores_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:30:00+02:00",)], "ts string")
    assert df.select(fx.local_date("ts").alias("d")).first().d == dt.date(2024, 1, 1)


def test_daily_rollup_equals_pandas(spark):
    import datetime as dt2

    from smogline.operators.rollup import daily_rollup

    rng = np.random.default_rng(5)
    base = dt2.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        sensor = 1 if i < 1500 else int(rng.integers(2, 6))  # sensor 1 is hot
        ts = base + dt2.timedelta(minutes=int(rng.integers(0, 3 * 1440)))
        rows.append(("c", sensor, ts.strftime("%Y-%m-%dT%H:%M:%S") + "+02:00", float(rng.normal(20, 5))))
    raw = spark.createDataFrame(rows, "city string, sensor_id long, ts_local string, value double")
    cols = ["city", "sensor_id", "date", "pm25_q25", "pm25_median", "pm25_q75", "pm25_avg"]
    a = sorted(daily_rollup(raw).select(*cols, "coverage", "n_readings").collect())
    pdf = raw.toPandas()
    pdf["date"] = pdf.ts_local.str[:10].map(dt.date.fromisoformat)
    g = pdf.groupby(["city", "sensor_id", "date"])
    want = {k: (*v.value.quantile([0.25, 0.5, 0.75]), v.value.mean(), v.ts_local.str[11:13].nunique() * 100 / 24, len(v)) for k, v in g}
    assert len(a) == len(want) > 0
    for x in a:
        assert list(x[3:]) == pytest.approx(list(want[x[:3]]), rel=1e-12)


def test_sketched_quantiles_of_odd_groups(spark):
    nan, inf = float("nan"), float("inf")
    groups = {"one": [4.0], "ties": [2.0] * 50 + [3.0], "none": [None, None], "odd": [inf, -inf, nan, 1.0, 2.0], "tail": [10.0 ** (i / 40) for i in range(1500)], None: [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(6)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["k"]: r for r in sketched_quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(groups) - {"none"}
    for k in ("one", "ties", "tail", None):
        want = pd.Series(groups[k]).quantile(list(probs.values()))
        assert all(abs(got[k][n] - w) <= 1e-9 * abs(w) for n, w in zip(probs, want)), k
    assert got["odd"]["a"] == -inf and got["odd"]["c"] == 2.0 and got["odd"]["e"] != got["odd"]["e"]


def test_a_long_tail_is_cut_evenly(spark):
    """Equal widths would put all but a few of these values into one slice."""
    n = 20_000
    df = spark.range(n).select(F.lit("x").alias("k"), F.exp(F.col("id") / 1000.0 * F.lit(2.0)).alias("v")).unionByName(
        spark.range(n).select(F.lit("y").alias("k"), (1e9 + F.col("id") / 1e4).alias("v"))).unionByName(spark.createDataFrame([("y", -1e15)], "k string, v double"))
    sizes = sketched_slices(df, ["k"], "v").groupBy("k", "_s").count().groupBy("k").agg(F.max("count").alias("most"), F.count("count").alias("slices")).collect()
    for r in sizes:
        assert r["most"] <= 3 * n / SLICES and r["slices"] > SLICES / 2
