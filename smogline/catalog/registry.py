"""Registered queries: one Spark callable per operator key, each paired
(where SQL can express it) with an equivalent DuckDB query.

Every query reads the driver's tables through the fixture adapters, so its
work grows with them.  Results are normalised the same way on both sides:
doubles rounded to multiples of 2^-``config.ROUND_BITS`` (sums run in
different orders) and integers widened to 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from .. import functions as fx
from ..operators import joins, quality, rollup, series, stats
from ..plans import forecast, monitoring
from ..plans import preprocess as pp
from ..sources import fixtures
from .sql_prelude import repaired_cte, rounded, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = fx.round_double(c.cast("double")) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, normalized: bool = True):
    def deco(fn):
        if normalized:
            QUERIES[name] = lambda spark, sf_dir: normalize(fn(spark, sf_dir))
        else:
            QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = rounded(sql, doubles or [])
        return fn

    return deco


# ---------------------------------------------------------------------------
# shared inputs (lazy plans)
# ---------------------------------------------------------------------------

def readings(spark, d):
    return fixtures.readings(spark, d)


def weather(spark, d):
    return fixtures.weather(spark, d)


def clean(spark, d):
    return quality.clean_positive(readings(spark, d))


def aq_eval(spark, d):
    return quality.average_sensors(clean(spark, d).select("date", "city", "sensor_id", "pm25_avg"))


def merged_eval(spark, d):
    wx = pp.filter_columns(weather(spark, d), remove=["temp_avg"])
    return joins.merge_sources(aq_eval(spark, d), wx)


def full(spark, d, mode="eval"):
    return pp.features_table(readings(spark, d), weather(spark, d), mode=mode)


def shared(spark, d, mode="eval"):
    """Feature table for queries that read it in several branches (schedule
    and scores): computed once and checkpointed to the shared folder, the
    way the processed table is stored and read back, instead of being
    recomputed per branch."""
    return full(spark, d, mode).checkpoint(eager=True)


def schedule(spark, d, f=None):
    f = full(spark, d) if f is None else f
    return monitoring.batch_schedule(f.select("date"))


def predictions(spark, d, f=None):
    f = full(spark, d) if f is None else f
    return monitoring.persistence_predictions(f)


def events(spark, d):
    return fixtures.event_readings(spark, d)


W_DOUBLES = ["temp_min", "temp_max", "cloud_cover", "humidity", "precipitation", "pressure", "wind_speed", "wind_direction"]
FEAT_DOUBLES = ["lag_1", "lag_3", "lag_7", "wind_speed", "precipitation", "lag_avg_14", "week_std", "wind_direction",
                "pressure", "temp_max", "humidity", "temp_min", "month_cos", "temp_gradient", "target"]
FULL_DOUBLES = W_DOUBLES + ["target", "temp_gradient", "month_cos", "month_sin", "lag_avg_14", "week_std",
                            "lag_1", "lag_2", "lag_3", "lag_7"]

# SQL fragments reused by several oracles
SCHED_CTES = {
    "bounds": "SELECT min(date) AS first, max(date) AS last FROM full_eval",
    "sched": """
SELECT CAST(i + 1 AS BIGINT) AS batch,
       CAST(last - 251 + 42 * i AS DATE) AS batch_start,
       CAST(last - 251 + 42 * i + 41 AS DATE) AS batch_end,
       first AS train_start,
       CAST(last - 251 + 42 * i - 1 AS DATE) AS train_end,
       CAST(last - 251 + 42 * i - 14 AS DATE) AS warmup_start
FROM bounds, (SELECT CAST(range AS INTEGER) AS i FROM range(6)) t""",
}
PRED_CTES = {
    "preds": """
SELECT date, city, exp(target) - 1 AS y_true, exp(lag_1) - 1 AS y_pred, '1' AS model_version FROM full_eval""",
}
MODEL_CTES = {
    "refwin": """
SELECT CAST(batch_start - 42 AS DATE) AS eval_start, CAST(batch_start - 1 AS DATE) AS eval_end, train_start
FROM sched WHERE batch = 1""",
    "refscore": """
SELECT r.eval_start, r.eval_end, r.train_start,
  sqrt(avg(power(f.target - f.lag_1, 2))) AS r1,
  sqrt(avg(power(f.target - greatest(f.lag_1 + (f.lag_1 - f.lag_2), 0.001), 2))) AS r2,
  sqrt(avg(power(f.target - (f.lag_1 + f.lag_2 + f.lag_3) / 3, 2))) AS r3
FROM full_eval f JOIN refwin r ON f.date BETWEEN r.eval_start AND r.eval_end - 1
GROUP BY r.eval_start, r.eval_end, r.train_start""",
    "models": """
SELECT v.model_version, s.train_start, CAST(s.eval_start - 1 AS DATE) AS train_end, s.eval_start, s.eval_end,
  CASE v.model_version WHEN '1' THEN s.r1 WHEN '2' THEN s.r2 ELSE s.r3 END AS reference_rmse, v.alias
FROM refscore s, (VALUES ('1', 'champion'), ('2', 'challenger'), ('3', 'archived')) v(model_version, alias)""",
}
BATCH_CTES = {
    "bscore": """
SELECT s.batch_start, s.batch_end,
  sqrt(avg(power(f.target - f.lag_1, 2))) AS champion_rmse,
  sqrt(avg(power(f.target - greatest(f.lag_1 + (f.lag_1 - f.lag_2), 0.001), 2))) AS challenger_rmse
FROM full_eval f JOIN sched s ON f.date BETWEEN s.batch_start AND s.batch_end - 1
GROUP BY s.batch, s.batch_start, s.batch_end""",
    "batches": """
SELECT b.batch_start, b.batch_end, '1' AS champion_version, b.champion_rmse,
  b.champion_rmse >= m.reference_rmse * 1.1 AS drift_detected,
  CASE WHEN b.champion_rmse >= m.reference_rmse * 1.1 THEN '2' END AS challenger_version,
  CASE WHEN b.champion_rmse >= m.reference_rmse * 1.1 THEN b.challenger_rmse END AS rmse_challenger,
  CAST(b.batch_end + 1 AS TIMESTAMP) AS run_date,
  CASE WHEN b.champion_rmse >= m.reference_rmse * 1.1 THEN b.challenger_rmse <= 0.99 * b.champion_rmse END
    AS promotion_applied
FROM bscore b, (SELECT reference_rmse FROM models WHERE model_version = '1') m""",
}


def _mon(*groups):
    out = {}
    for g in groups:
        out.update(g)
    return out


# ---------------------------------------------------------------------------
# §2.1 scans, sources
# ---------------------------------------------------------------------------

@register(
    "local_date",
    with_ctes("""
SELECT event_id, ts_local, CAST(substr(ts_local, 1, 10) AS DATE) AS date, CAST(ts AS DATE) AS utc_date
FROM events_raw""", "events_raw"),
)
def q_local_date(spark, d):
    e = events(spark, d)
    return e.select("event_id", "ts_local", fx.local_date("ts_local").alias("date"), F.to_date("ts").alias("utc_date"))


ROLLUP_DOUBLES = ["pm25_avg", "pm25_min", "pm25_q25", "pm25_median", "pm25_q75", "pm25_max", "coverage"]


@register(
    "daily_rollup",
    with_ctes("""
SELECT city, sensor_id, CAST(substr(ts_local, 1, 10) AS DATE) AS date,
  avg(value) AS pm25_avg, min(value) AS pm25_min,
  quantile_cont(value, 0.25) AS pm25_q25, quantile_cont(value, 0.5) AS pm25_median,
  quantile_cont(value, 0.75) AS pm25_q75, max(value) AS pm25_max,
  count(DISTINCT substr(ts_local, 12, 2)) * 100.0 / 24 AS coverage,
  count(*) AS n_readings
FROM events_raw GROUP BY 1, 2, 3""", "events_raw"),
    ROLLUP_DOUBLES,
)
def q_daily_rollup(spark, d):
    from ..operators.rollup import daily_rollup

    return daily_rollup(events(spark, d))


@register(
    "admit_payload",
    with_ctes("""
SELECT r.city, r.sensor_id, r.date, r.pm25_avg FROM readings r JOIN (SELECT city, sensor_id FROM readings GROUP BY city, sensor_id
  HAVING count(*) / (SELECT max(date) - min(date) + 1 FROM readings) >= 0.5) USING (city, sensor_id)""", "readings"),
    ["pm25_avg"],
)
def q_admit_payload(spark, d):
    from ..operators.rollup import admit_payload

    # half the calendar: the threshold that parts the sensors of these tables
    return admit_payload(readings(spark, d), threshold=0.5).select("city", "sensor_id", "date", "pm25_avg")


@register(
    "missing_dates",
    with_ctes("""
SELECT w.city, w.date FROM weather w
WHERE NOT EXISTS (SELECT 1 FROM aq_eval a WHERE a.city = w.city AND a.date = w.date)""", "weather", "aq_eval"),
)
def q_missing_dates(spark, d):
    from ..operators.rollup import missing_dates

    return missing_dates(weather(spark, d).select("city", "date"), aq_eval(spark, d))


@register(
    "completeness_report",
    with_ctes("""
SELECT w.city, count(*) AS days_expected, count(a.pm25_avg) AS days_held,
  count(*) = count(a.pm25_avg) AS complete
FROM weather w LEFT JOIN aq_eval a ON a.city = w.city AND a.date = w.date GROUP BY w.city""", "weather", "aq_eval"),
)
def q_completeness_report(spark, d):
    from ..operators.rollup import completeness_report

    return completeness_report(weather(spark, d).select("city", "date"), aq_eval(spark, d))


@register(
    "union_sources",
    with_ctes("""
SELECT city, sensor_id, date, pm25_avg, 'lineitem' AS source, 'no data in any source' AS without_rows FROM readings
UNION ALL
SELECT city, sensor_id, date, pm25_avg, 'orders' AS source, 'no data in any source' FROM readings_sparse""", "readings", "readings_sparse"),
    ["pm25_avg"],
)
def q_union_sources(spark, d):
    """The union of both sources; ``without_rows`` says how the union answers to
    the same sources when no row of theirs is left."""
    a = readings(spark, d).withColumn("source", F.lit("lineitem"))
    b = fixtures.readings_sparse(spark, d).withColumn("source", F.lit("orders"))
    try:
        rollup.union_sources([a.filter("date IS NULL"), b.filter("date IS NULL")])
        refused = "accepted"
    except ValueError as e:
        refused = str(e)
    return rollup.union_sources([a, b]).withColumn("without_rows", F.lit(refused))


# ---------------------------------------------------------------------------
# §2.2 projections and filters
# ---------------------------------------------------------------------------

@register("filter_columns", with_ctes("SELECT * EXCLUDE (temp_avg) FROM weather", "weather"), W_DOUBLES)
def q_filter_columns(spark, d):
    return pp.filter_columns(weather(spark, d), remove=["temp_avg"])


@register("clean_positive", with_ctes("SELECT * FROM clean", "clean"), ["pm25_avg"])
def q_clean_positive(spark, d):
    return clean(spark, d)


@register(
    "clean_report",
    with_ctes("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE pm25_avg <= 0) AS non_positive_rows,
  100.0 * count(*) FILTER (WHERE pm25_avg <= 0) / count(*) AS non_positive_pct FROM readings""", "readings"),
    ["non_positive_pct"],
)
def q_clean_report(spark, d):
    return quality.clean_report(readings(spark, d))


@register(
    "drop_incomplete",
    with_ctes("SELECT * FROM merged_eval WHERE pm25_avg IS NOT NULL", "merged_eval"),
    W_DOUBLES + ["pm25_avg"],
)
def q_drop_incomplete(spark, d):
    return quality.drop_incomplete(merged_eval(spark, d))


@register("drop_helper_cols", with_ctes("SELECT * FROM full_eval", "full_eval"), FULL_DOUBLES)
def q_drop_helper_cols(spark, d):
    return full(spark, d)


@register(
    "project_features",
    with_ctes(f"SELECT {', '.join(config.SELECTED_FEATURES)}, date, target FROM full_eval", "full_eval"),
    FEAT_DOUBLES,
)
def q_project_features(spark, d):
    return full(spark, d).select(*config.SELECTED_FEATURES, "date", "target")


@register(
    "select_series_range",
    with_ctes("""
SELECT * FROM preds WHERE city = (SELECT min(city) FROM preds)
  AND date BETWEEN (SELECT batch_start FROM sched WHERE batch = 1) AND (SELECT batch_end FROM sched WHERE batch = 6)""",
              "full_eval", extra=_mon(SCHED_CTES, PRED_CTES)),
    ["y_true", "y_pred"],
)
def q_select_series_range(spark, d):
    f = shared(spark, d)
    p = predictions(spark, d, f)
    s = schedule(spark, d, f)
    city = p.select(F.min("city")).scalar()
    lo = s.filter(F.col("batch") == 1).select("batch_start").scalar()
    hi = s.filter(F.col("batch") == 6).select("batch_end").scalar()
    return monitoring.select_series_range(p, city, lo, hi)


@register("warmup_start", with_ctes("SELECT batch, batch_start, warmup_start FROM sched", "full_eval", extra=SCHED_CTES))
def q_warmup_start(spark, d):
    return schedule(spark, d).select("batch", "batch_start", "warmup_start")


@register(
    "null_flags_false",
    with_ctes("""
SELECT batch_start, coalesce(drift_detected, false) AS drift_detected,
  coalesce(promotion_applied, false) AS promotion_applied FROM batches ORDER BY batch_start DESC""",
              "full_eval", extra=_mon(SCHED_CTES, MODEL_CTES, BATCH_CTES)),
)
def q_null_flags_false(spark, d):
    b = batches(spark, d)
    return b.select(
        "batch_start",
        F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"),
        F.coalesce("promotion_applied", F.lit(False)).alias("promotion_applied"),
    ).orderBy(F.col("batch_start").desc())


# ---------------------------------------------------------------------------
# §2.3 joins
# ---------------------------------------------------------------------------

@register(
    "assert_columns",
    with_ctes(f"SELECT {', '.join(config.MERGED_COLUMNS)} FROM merged_eval", "merged_eval"),
    W_DOUBLES + ["pm25_avg"],
)
def q_assert_columns(spark, d):
    """Merged columns checked against the expected set, then put in order."""
    wx = pp.filter_columns(weather(spark, d), remove=["temp_avg"])
    raw = wx.join(aq_eval(spark, d), ["date", "city"], "left")
    return joins.assert_columns(raw, config.MERGED_COLUMNS)


@register("merge_sources", with_ctes("SELECT * FROM merged_eval", "merged_eval"), W_DOUBLES + ["pm25_avg"])
def q_merge_sources(spark, d):
    return merged_eval(spark, d)


@register("exclude_sensors", with_ctes("SELECT * FROM kept", "kept"), ["pm25_avg"])
def q_exclude_sensors(spark, d):
    c = clean(spark, d)
    return quality.exclude_sensors(c, quality.flagged_sensors(c))


@register(
    "assign_batch",
    with_ctes("""
SELECT f.city, f.date, s.batch FROM full_eval f JOIN sched s ON f.date BETWEEN s.batch_start AND s.batch_end""",
              "full_eval", extra=SCHED_CTES),
)
def q_assign_batch(spark, d):
    f = shared(spark, d)
    return joins.assign_batch(f.select("city", "date"), schedule(spark, d, f)).select("city", "date", "batch")


# ---------------------------------------------------------------------------
# §2.4 aggregations
# ---------------------------------------------------------------------------

@register("sensor_gap_stats", with_ctes("SELECT * FROM gap_stats", "gap_stats"), ["gap_median", "gap_q75"])
def q_sensor_gap_stats(spark, d):
    return quality.sensor_gap_stats(clean(spark, d))


@register(
    "sensor_gap_stats_sparse",
    with_ctes("""
SELECT city, sensor_id, count(*) AS gap_count, max(delta) AS gap_max,
  quantile_cont(CAST(delta AS DOUBLE), 0.5) AS gap_median, quantile_cont(CAST(delta AS DOUBLE), 0.75) AS gap_q75
FROM (SELECT city, sensor_id, CAST(date - lag(date) OVER (PARTITION BY sensor_id ORDER BY date) AS BIGINT) AS delta
      FROM readings_sparse WHERE pm25_avg > 0) t
WHERE delta > 1 GROUP BY city, sensor_id""", "readings_sparse"),
    ["gap_median", "gap_q75"],
)
def q_sensor_gap_stats_sparse(spark, d):
    return quality.sensor_gap_stats(quality.clean_positive(fixtures.readings_sparse(spark, d)))


@register("flag_gap_sensors", with_ctes("SELECT * FROM gap_flag", "gap_flag"))
def q_flag_gap_sensors(spark, d):
    return quality.flag_gap_sensors(clean(spark, d))


@register(
    "flag_gap_sensors_sparse",
    with_ctes("""
SELECT sensor_id FROM (
  SELECT city, sensor_id, max(delta) AS gap_max, quantile_cont(CAST(delta AS DOUBLE), 0.75) AS gap_q75
  FROM (SELECT city, sensor_id, CAST(date - lag(date) OVER (PARTITION BY sensor_id ORDER BY date) AS BIGINT) AS delta
        FROM readings_sparse WHERE pm25_avg > 0) t
  WHERE delta > 1 GROUP BY city, sensor_id) s
WHERE gap_max >= 30 OR gap_q75 >= 10.0""", "readings_sparse"),
)
def q_flag_gap_sensors_sparse(spark, d):
    return quality.flag_gap_sensors(quality.clean_positive(fixtures.readings_sparse(spark, d)))


@register("monthly_coverage", with_ctes("SELECT * FROM cov_month", "cov_month"), ["coverage_pct"])
def q_monthly_coverage(spark, d):
    return quality.monthly_coverage(clean(spark, d))


@register("flag_coverage_sensors", with_ctes("SELECT * FROM cov_flag", "cov_flag"))
def q_flag_coverage_sensors(spark, d):
    return quality.flag_coverage_sensors(clean(spark, d))


@register("flag_union", with_ctes("SELECT * FROM flagged", "flagged"))
def q_flag_union(spark, d):
    return quality.flagged_sensors(clean(spark, d))


@register("filter_sensors", with_ctes("SELECT * FROM kept", "kept"), ["pm25_avg"])
def q_filter_sensors(spark, d):
    return quality.filter_sensors(clean(spark, d))


@register(
    "filter_report",
    with_ctes("""
SELECT (SELECT count(DISTINCT sensor_id) FROM clean) AS sensors_before,
       (SELECT count(DISTINCT sensor_id) FROM kept) AS sensors_after,
       (SELECT count(DISTINCT sensor_id) FROM clean) - (SELECT count(DISTINCT sensor_id) FROM kept) AS sensors_removed""",
              "kept"),
)
def q_filter_report(spark, d):
    c = clean(spark, d)
    return quality.filter_report(c, quality.filter_sensors(c))


@register("average_sensors", with_ctes("SELECT * FROM aq_eval", "aq_eval"), ["pm25_avg"])
def q_average_sensors(spark, d):
    return aq_eval(spark, d)


@register(
    "average_sensors_multi",
    with_ctes("""
SELECT city, date, avg(pm25_avg) AS pm25_avg, avg(pm25_min) AS pm25_min, avg(pm25_q25) AS pm25_q25,
  avg(pm25_median) AS pm25_median, avg(pm25_q75) AS pm25_q75, avg(pm25_max) AS pm25_max
FROM (SELECT city, sensor_id, CAST(substr(ts_local, 1, 10) AS DATE) AS date,
        avg(value) AS pm25_avg, min(value) AS pm25_min, quantile_cont(value, 0.25) AS pm25_q25,
        quantile_cont(value, 0.5) AS pm25_median, quantile_cont(value, 0.75) AS pm25_q75, max(value) AS pm25_max
      FROM events_raw GROUP BY 1, 2, 3) r
WHERE pm25_avg > 0
GROUP BY city, date""", "events_raw"),
    ["pm25_avg", "pm25_min", "pm25_q25", "pm25_median", "pm25_q75", "pm25_max"],
)
def q_average_sensors_multi(spark, d):
    from ..operators.rollup import daily_rollup

    r = quality.clean_positive(daily_rollup(events(spark, d)))
    return quality.average_sensors(r, ["pm25_avg", "pm25_min", "pm25_q25", "pm25_median", "pm25_q75", "pm25_max"])


@register(
    "match_rate",
    with_ctes("""
SELECT count(pm25_avg) AS matched_days, count(*) AS total_days, count(pm25_avg) / count(*) AS match_rate
FROM merged_eval""", "merged_eval"),
    ["match_rate"],
)
def q_match_rate(spark, d):
    return quality.match_rate(merged_eval(spark, d))


@register(
    "dataset_metadata",
    with_ctes(f"""
SELECT min(date) AS date_start, max(date) AS date_end, count(*) AS n_rows,
  CAST({len(config.SELECTED_FEATURES)} AS BIGINT) AS n_features,
  '{','.join(config.SELECTED_FEATURES)}' AS list_features
FROM full_eval""", "full_eval"),
)
def q_dataset_metadata(spark, d):
    p = full(spark, d).select(*config.SELECTED_FEATURES, "date", "target")
    m = pp.dataset_metadata(p, config.SELECTED_FEATURES)
    return m.withColumn("list_features", F.array_join("list_features", ","))


@register(
    "negative_share",
    with_ctes("""
SELECT city, sensor_id, count(pm25_avg) AS total, count(*) FILTER (WHERE pm25_avg < 0) AS neg_values,
  count(*) FILTER (WHERE pm25_avg < 0) / count(pm25_avg) * 100 AS pct_neg
FROM readings GROUP BY city, sensor_id""", "readings"),
    ["pct_neg"],
)
def q_negative_share(spark, d):
    return quality.negative_share(readings(spark, d))


@register(
    "skew_by_city",
    with_ctes("SELECT city, skewness(pm25_avg) AS skew, skewness(ln(1 + pm25_avg)) AS skew_log1p FROM aq_eval GROUP BY city",
              "aq_eval"),
    ["skew", "skew_log1p"],
)
def q_skew_by_city(spark, d):
    return stats.skew_by_city(aq_eval(spark, d))


@register(
    "kurtosis_by_city",
    with_ctes("SELECT city, kurtosis_pop(pm25_avg) AS kurtosis FROM aq_eval GROUP BY city", "aq_eval"),
    ["kurtosis"],
)
def q_kurtosis_by_city(spark, d):
    return stats.kurtosis_by_city(aq_eval(spark, d))


@register(
    "peak_day",
    with_ctes("""
SELECT a.city, m.mx AS peak_value, min(a.date) AS peak_date
FROM aq_eval a JOIN (SELECT city, max(pm25_avg) AS mx FROM aq_eval GROUP BY city) m
  ON a.city = m.city AND a.pm25_avg = m.mx
GROUP BY a.city, m.mx""", "aq_eval"),
    ["peak_value"],
)
def q_peak_day(spark, d):
    return stats.peak_day(aq_eval(spark, d))


def _hist_sql(expr: str, lo: float, hi: float, n: int) -> str:
    return f"""
SELECT city, CASE WHEN v < {lo} THEN 0 WHEN v >= {hi} THEN {n + 1}
                  ELSE CAST(floor((v - {lo}) / ({hi} - {lo}) * {n}) AS BIGINT) + 1 END AS bucket,
       count(*) AS n
FROM (SELECT city, {expr} AS v FROM aq_eval WHERE pm25_avg IS NOT NULL) t GROUP BY 1, 2"""


@register("value_histogram", with_ctes(_hist_sql("pm25_avg", 0.0, 100.0, 20), "aq_eval"))
def q_value_histogram(spark, d):
    return stats.value_histogram(aq_eval(spark, d), lo=0.0, hi=100.0, buckets=20)


@register("value_histogram_log", with_ctes(_hist_sql("ln(1 + pm25_avg)", 0.0, 5.0, 20), "aq_eval"))
def q_value_histogram_log(spark, d):
    return stats.value_histogram(aq_eval(spark, d), lo=0.0, hi=5.0, buckets=20, log=True)


def _box_sql(keys: list[str], key_exprs: list[str]) -> str:
    k = ", ".join(keys)
    sel = ", ".join(f"{e} AS {n}" for n, e in zip(keys, key_exprs))
    on = " AND ".join(f"v.{n} = q.{n}" for n in keys)
    qk = ", ".join(f"q.{n}" for n in keys)
    return f"""
, v AS (SELECT {sel}, pm25_avg FROM aq_eval),
q AS (SELECT {k}, count(pm25_avg) AS n, quantile_cont(pm25_avg, 0.25) AS q1, quantile_cont(pm25_avg, 0.5) AS median,
        quantile_cont(pm25_avg, 0.75) AS q3, quantile_cont(pm25_avg, 0.75) - quantile_cont(pm25_avg, 0.25) AS iqr
      FROM v GROUP BY {k})
SELECT {qk}, q.n, q.q1, q.median, q.q3, q.iqr,
  min(v.pm25_avg) FILTER (WHERE v.pm25_avg BETWEEN q.q1 - 1.5 * q.iqr AND q.q3 + 1.5 * q.iqr) AS whisker_low,
  max(v.pm25_avg) FILTER (WHERE v.pm25_avg BETWEEN q.q1 - 1.5 * q.iqr AND q.q3 + 1.5 * q.iqr) AS whisker_high,
  count(*) FILTER (WHERE NOT (v.pm25_avg BETWEEN q.q1 - 1.5 * q.iqr AND q.q3 + 1.5 * q.iqr)) AS outliers
FROM v JOIN q ON {on}
GROUP BY {qk}, q.n, q.q1, q.median, q.q3, q.iqr"""


BOX_DOUBLES = ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]


def _box_query(keys, key_exprs, kind):
    sql = with_ctes("SELECT 1", "aq_eval")
    sql = sql[: sql.rindex("SELECT 1")].rstrip() + _box_sql(keys, key_exprs)

    def fn(spark, d):
        a = aq_eval(spark, d)
        return stats.box_stats(a.select(*_box_cols(kind), "pm25_avg"), keys)

    return sql, fn


def _box_cols(kind):
    if kind == "city":
        return [F.col("city")]
    if kind == "month":
        return [F.col("city"), F.month("date").cast("long").alias("month")]
    if kind == "weekend":
        return [F.col("city"), fx.is_weekend("date").cast("long").alias("is_weekend")]
    return [F.col("city"), fx.day_of_week("date").cast("long").alias("dow")]


for _name, _keys, _exprs, _kind in [
    ("box_stats", ["city"], ["city"], "city"),
    ("box_stats_month", ["city", "month"], ["city", "CAST(month(date) AS BIGINT)"], "month"),
    ("box_stats_weekend", ["city", "is_weekend"], ["city", "CAST(isodow(date) >= 6 AS BIGINT)"], "weekend"),
    ("box_stats_dow", ["city", "dow"], ["city", "CAST(isodow(date) - 1 AS BIGINT)"], "dow"),
]:
    _sql, _fn = _box_query(_keys, _exprs, _kind)
    register(_name, _sql, BOX_DOUBLES)(_fn)


DESCRIBE_COLS = ["target", "lag_1", "lag_3", "lag_7", "lag_avg_14", "week_std", "wind_speed", "precipitation",
                 "wind_direction", "pressure", "temp_max", "humidity", "temp_min", "month_cos", "temp_gradient"]


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        parts.append(f"""
SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS "min",
  quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75,
  max({c}) AS "max" FROM full_eval""")
    return with_ctes("\nUNION ALL".join(parts), "full_eval")


@register("describe", _describe_sql(), ["mean", "std", "min", "q25", "median", "q75", "max"])
def q_describe(spark, d):
    return stats.describe(full(spark, d), DESCRIBE_COLS)


@register(
    "rmse",
    with_ctes("SELECT sqrt(avg(power(target - lag_1, 2))) AS rmse, count(*) AS n_rows FROM full_eval", "full_eval"),
    ["rmse"],
)
def q_rmse(spark, d):
    return full(spark, d).agg(stats.rmse_col("target", "lag_1").alias("rmse"), F.count(F.lit(1)).alias("n_rows"))


@register(
    "rmsle",
    with_ctes("""
SELECT city, sqrt(avg(power(ln(1 + y_true) - ln(1 + y_pred), 2))) AS rmsle FROM preds GROUP BY city""",
              "full_eval", extra=PRED_CTES),
    ["rmsle"],
)
def q_rmsle(spark, d):
    return predictions(spark, d).groupBy("city").agg(stats.rmsle_col("y_true", "y_pred").alias("rmsle"))


# ---------------------------------------------------------------------------
# §2.5 windows
# ---------------------------------------------------------------------------

@register("sensor_day_gaps", with_ctes("SELECT * FROM sdays", "sdays"))
def q_sensor_day_gaps(spark, d):
    return quality.sensor_day_gaps(clean(spark, d).select("city", "sensor_id", "date"))


@register(
    "gap_events",
    with_ctes("SELECT city, sensor_id, date AS gap_end, delta AS gap_days FROM sdays WHERE delta > 1", "sdays"),
)
def q_gap_events(spark, d):
    return quality.gap_events(clean(spark, d))


@register(
    "assert_contiguous",
    with_ctes("""
SELECT CAST(max(step) AS BIGINT) AS max_step, count(*) AS n_rows
FROM (SELECT date - lag(date) OVER (PARTITION BY city ORDER BY date) AS step FROM weather) t""", "weather"),
)
def q_assert_contiguous(spark, d):
    return series.max_step(weather(spark, d))


REPAIRED_DOUBLES = W_DOUBLES + ["pm25_avg"]


@register("impute_gaps", with_ctes("SELECT * FROM repaired_eval", "repaired_eval"), REPAIRED_DOUBLES)
def q_impute_gaps(spark, d):
    return series.impute_gaps(merged_eval(spark, d))


@register(
    "impute_gaps_limit2",
    with_ctes("SELECT * FROM rep2", "tagged_eval", extra={"rep2": repaired_cte("tagged_eval", 2)}),
    REPAIRED_DOUBLES,
)
def q_impute_gaps_limit2(spark, d):
    return series.impute_gaps(merged_eval(spark, d), limit=2)


@register(
    "generate_target",
    with_ctes("""
SELECT city, date, pm25_avg, lead(pm25_avg, 1) OVER (PARTITION BY city ORDER BY date) AS target
FROM repaired_eval""", "repaired_eval"),
    ["pm25_avg", "target"],
)
def q_generate_target(spark, d):
    r = series.impute_gaps(merged_eval(spark, d)).select("city", "date", "pm25_avg")
    return series.generate_target(r)


def _lags_sql(shifts: dict) -> str:
    cols = ", ".join(
        ("pm25_avg" if k == 0 else f"lag(pm25_avg, {k}) OVER w") + f" AS {out}" for out, (_, k) in shifts.items()
    )
    return with_ctes(f"""
SELECT city, date, {cols} FROM logged_eval WINDOW w AS (PARTITION BY city ORDER BY date)""", "logged_eval")


def _lags_query(shifts: dict):
    def fn(spark, d):
        r = series.impute_gaps(merged_eval(spark, d)).select("city", "date", F.log1p("pm25_avg").alias("pm25_avg"))
        return r.select("city", "date", *series.lag_columns(shifts))

    return fn


for _name, _shifts in [
    ("lag_features_custom", config.CUSTOM_SHIFTS),
    ("lag_features_14", config.ALL_LAGS_14_SHIFTS),
    ("lag_features_21", config.ALL_LAGS_21_SHIFTS),
]:
    register(_name, _lags_sql(_shifts), list(_shifts))(_lags_query(_shifts))


def _logged(spark, d):
    return series.impute_gaps(merged_eval(spark, d)).select("city", "date", F.log1p("pm25_avg").alias("pm25_avg"))


@register(
    "lag_avg_14",
    with_ctes("""
SELECT city, date, (lag(pm25_avg, 12) OVER w + lag(pm25_avg, 13) OVER w + lag(pm25_avg, 14) OVER w) / 3 AS lag_avg_14
FROM logged_eval WINDOW w AS (PARTITION BY city ORDER BY date)""", "logged_eval"),
    ["lag_avg_14"],
)
def q_lag_avg_14(spark, d):
    return series.lag_avg_14(_logged(spark, d)).select("city", "date", "lag_avg_14")


@register(
    "week_std",
    with_ctes("""
SELECT city, date, CASE WHEN count(pm25_avg) OVER w7 = 7 THEN stddev_samp(pm25_avg) OVER w7 END AS week_std
FROM logged_eval WINDOW w7 AS (PARTITION BY city ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
              "logged_eval"),
    ["week_std"],
)
def q_week_std(spark, d):
    return series.week_std(_logged(spark, d)).select("city", "date", "week_std")


@register(
    "rolling_mean_30",
    with_ctes("""
SELECT city, date, CASE WHEN count(pm25_avg) OVER w = 30 THEN avg(pm25_avg) OVER w END AS rolling_mean_30
FROM aq_eval WINDOW w AS (PARTITION BY city ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""", "aq_eval"),
    ["rolling_mean_30"],
)
def q_rolling_mean_30(spark, d):
    return series.rolling_mean(aq_eval(spark, d), window=30).select("city", "date", "rolling_mean_30")


def _sweep_sql() -> str:
    cols = []
    for k in range(2, 31):
        f = f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW"
        cols.append(
            f"CASE WHEN count(pm25_avg) OVER (PARTITION BY city ORDER BY date {f}) = {k} "
            f"THEN avg(pm25_avg) OVER (PARTITION BY city ORDER BY date {f}) END AS m{k}"
        )
        cols.append(
            f"CASE WHEN count(pm25_avg) OVER (PARTITION BY city ORDER BY date {f}) = {k} "
            f"THEN stddev_samp(pm25_avg) OVER (PARTITION BY city ORDER BY date {f}) END AS s{k}"
        )
    rolled = f"SELECT city, {', '.join(cols)} FROM aq_eval"
    unions = "\nUNION ALL\n".join(
        f"SELECT city, CAST({k} AS BIGINT) AS k, stddev_samp(m{k}) AS std_rolling_mean, stddev_samp(s{k}) AS std_rolling_std "
        "FROM rolled GROUP BY city"
        for k in range(2, 31)
    )
    return with_ctes(unions, "aq_eval", extra={"rolled": rolled})


@register("rolling_sweep", _sweep_sql(), ["std_rolling_mean", "std_rolling_std"])
def q_rolling_sweep(spark, d):
    return stats.rolling_sweep(aq_eval(spark, d))


def _acf_sql(nlags: int = config.ACF_LAGS) -> str:
    extra = {
        "cx": """
SELECT city, row_number() OVER (PARTITION BY city ORDER BY date) AS rn,
  pm25_avg - avg(pm25_avg) OVER (PARTITION BY city) AS d FROM aq_eval""",
        "den": "SELECT city, sum(d * d) AS s0, count(*) AS n FROM cx GROUP BY city",
        "num": f"""
SELECT a.city, CAST(k.k AS BIGINT) AS lag, sum(a.d * b.d) AS s
FROM cx a JOIN range(1, {nlags + 1}) k(k) ON true JOIN cx b ON b.city = a.city AND b.rn = a.rn + k.k
GROUP BY a.city, k.k""",
        "r": """
SELECT den.city, lags.lag, coalesce(num.s, 0) / den.s0 AS acf, den.n
FROM den JOIN (SELECT CAST(k AS BIGINT) AS lag FROM range(1, 61) t(k)) lags ON true
LEFT JOIN num ON num.city = den.city AND num.lag = lags.lag""",
    }
    body = f"""
SELECT city, lag, acf,
  {config.Z_975} * sqrt((1 + 2 * coalesce(sum(acf * acf) OVER (PARTITION BY city ORDER BY lag
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) AS band
FROM r"""
    return with_ctes(body, "aq_eval", extra=extra)


@register("acf", _acf_sql(), ["acf", "band"])
def q_acf(spark, d):
    return stats.acf(aq_eval(spark, d))


def _pacf_sql(nlags: int = config.ACF_LAGS) -> str:
    """Durbin-Levinson as a recursive CTE over each city's list of ACF values."""
    acf = _acf_sql(nlags)
    head, body = acf.split("\nSELECT city, lag, acf,", 1)
    rec = f"""
, rl AS (SELECT city, list(acf ORDER BY lag) AS r FROM r GROUP BY city),
dl AS (
  SELECT city, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS v, CAST(NULL AS DOUBLE) AS a FROM rl
  UNION ALL
  SELECT city, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a1 * phi[k + 1 - j]), a1),
         v * (1 - a1 * a1), a1
  FROM (SELECT dl.city, dl.k, dl.phi, dl.v,
               (rl.r[dl.k + 1] - coalesce(list_sum(list_transform(range(1, dl.k + 1), lambda j: dl.phi[j] * rl.r[dl.k + 1 - j])), 0))
                 / dl.v AS a1
        FROM dl JOIN rl ON rl.city = dl.city WHERE dl.k < {nlags}) t
)
SELECT city, CAST(k AS BIGINT) AS lag, a AS pacf FROM dl WHERE k >= 1"""
    return "WITH RECURSIVE " + head[len("WITH "):] + rec


@register("pacf", _pacf_sql(), ["pacf"])
def q_pacf(spark, d):
    return stats.pacf(stats.acf(aq_eval(spark, d)))


# ---------------------------------------------------------------------------
# §2.6 sorts / §2.7 set operations
# ---------------------------------------------------------------------------

@register("sort_series", with_ctes("SELECT * FROM clean ORDER BY city, date", "clean"), ["pm25_avg"])
def q_sort_series(spark, d):
    return clean(spark, d).orderBy("city", "date")


@register(
    "sort_by_date",
    with_ctes(f"SELECT {', '.join(config.SELECTED_FEATURES)}, date, target FROM full_eval ORDER BY date, city",
              "full_eval"),
    FEAT_DOUBLES,
)
def q_sort_by_date(spark, d):
    return full(spark, d).select(*config.SELECTED_FEATURES, "date", "target").orderBy("date", "city")


BATCH_DOUBLES = ["champion_rmse", "rmse_challenger"]


@register(
    "latest_batches",
    with_ctes("SELECT * FROM batches ORDER BY batch_start DESC", "full_eval",
              extra=_mon(SCHED_CTES, MODEL_CTES, BATCH_CTES)),
    BATCH_DOUBLES,
)
def q_latest_batches(spark, d):
    return batches(spark, d).orderBy(F.col("batch_start").desc())


@register("distinct_series", with_ctes("SELECT DISTINCT city FROM readings", "readings"))
def q_distinct_series(spark, d):
    return readings(spark, d).select("city").distinct()


# ---------------------------------------------------------------------------
# §2.8 scalar functions
# ---------------------------------------------------------------------------

@register(
    "target_transform",
    with_ctes("""
SELECT city, date, ln(1 + pm25_avg) AS pm25_avg,
  ln(1 + lead(pm25_avg, 1) OVER (PARTITION BY city ORDER BY date)) AS target FROM repaired_eval""", "repaired_eval"),
    ["pm25_avg", "target"],
)
def q_target_transform(spark, d):
    r = series.generate_target(series.impute_gaps(merged_eval(spark, d)).select("city", "date", "pm25_avg"))
    return r.select("city", "date", fx.log1p("pm25_avg").alias("pm25_avg"), fx.log1p("target").alias("target"))


@register(
    "inverse_target",
    with_ctes("SELECT date, city, exp(target) - 1 AS y_true, exp(lag_1) - 1 AS y_pred FROM full_eval", "full_eval"),
    ["y_true", "y_pred"],
)
def q_inverse_target(spark, d):
    return full(spark, d).select("date", "city", fx.expm1("target").alias("y_true"), fx.expm1("lag_1").alias("y_pred"))


@register(
    "month_encoding",
    with_ctes("""
SELECT city, date, cos(month(date) * 2 * pi() / 12) AS month_cos, sin(month(date) * 2 * pi() / 12) AS month_sin
FROM weather""", "weather"),
    ["month_cos", "month_sin"],
)
def q_month_encoding(spark, d):
    return weather(spark, d).select("city", "date", *pp.calendar_columns()[:2])


@register(
    "day_encoding",
    with_ctes("""
SELECT city, date, CAST(isodow(date) - 1 AS BIGINT) AS dow, CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend
FROM weather""", "weather"),
)
def q_day_encoding(spark, d):
    return weather(spark, d).select("city", "date", *pp.calendar_columns()[2:])


@register(
    "temp_gradient",
    with_ctes("SELECT city, date, temp_max - temp_min AS temp_gradient FROM weather", "weather"),
    ["temp_gradient"],
)
def q_temp_gradient(spark, d):
    return weather(spark, d).select("city", "date", fx.temp_gradient().alias("temp_gradient"))


@register(
    "days_in_month",
    with_ctes("""
SELECT city, date, last_day(date) AS month_end, CAST(day(last_day(date)) AS BIGINT) AS days_in_month FROM weather""",
              "weather"),
)
def q_days_in_month(spark, d):
    return weather(spark, d).select(
        "city", "date", F.last_day("date").alias("month_end"), fx.days_in_month("date").alias("days_in_month")
    )


@register(
    "clip_lower",
    with_ctes("""
SELECT city, date, greatest(lag_1 + (lag_1 - lag_2), 0.001) AS y_pred FROM full_eval""", "full_eval"),
    ["y_pred"],
)
def q_clip_lower(spark, d):
    f = full(spark, d)
    return f.select("city", "date", fx.clip_lower(F.col("lag_1") + (F.col("lag_1") - F.col("lag_2"))).alias("y_pred"))


@register(
    "relative_improvement",
    with_ctes("""
SELECT batch_start, CASE WHEN champion_rmse IS NULL OR champion_rmse = 0 THEN NULL
                         ELSE 100 * (1 - challenger_rmse / champion_rmse) END AS pct_vs_prod
FROM bscore""", "full_eval", extra=_mon(SCHED_CTES, BATCH_CTES)),
    ["pct_vs_prod"],
)
def q_relative_improvement(spark, d):
    s = batch_scores(spark, d)
    return s.select("batch_start", fx.relative_improvement("challenger_rmse", "champion_rmse").alias("pct_vs_prod"))


# ---------------------------------------------------------------------------
# §2.9 feature chain
# ---------------------------------------------------------------------------

@register(
    "feature_engineering",
    with_ctes("SELECT * FROM feat_eval", "feat_eval"),
    FULL_DOUBLES + ["pm25_avg"],
)
def q_feature_engineering(spark, d):
    return pp.featured_table(readings(spark, d), weather(spark, d), mode="eval")


@register(
    "preprocess_eval",
    with_ctes(f"SELECT {', '.join(config.SELECTED_FEATURES)}, date, target FROM full_eval", "full_eval"),
    FEAT_DOUBLES,
)
def q_preprocess_eval(spark, d):
    return pp.preprocess_eval(readings(spark, d), weather(spark, d))


@register(
    "preprocess_train",
    with_ctes(f"SELECT {', '.join(config.SELECTED_FEATURES)}, date, target FROM full_train", "full_train"),
    FEAT_DOUBLES,
)
def q_preprocess_train(spark, d):
    return pp.preprocess_train(readings(spark, d), weather(spark, d))


@register(
    "evaluation_slice",
    with_ctes(f"""
SELECT {', '.join(config.SELECTED_FEATURES)}, f.date, target FROM full_eval f, sched s
WHERE s.batch = 6 AND f.date BETWEEN s.batch_start AND s.batch_end""", "full_eval", extra=SCHED_CTES),
    FEAT_DOUBLES,
)
def q_evaluation_slice(spark, d):
    f = shared(spark, d)
    s = schedule(spark, d, f).filter(F.col("batch") == 6)
    lo = s.select("batch_start").scalar()
    hi = s.select("batch_end").scalar()
    return pp.evaluation_slice(f, lo, hi).select(*config.SELECTED_FEATURES, "date", "target")


# ---------------------------------------------------------------------------
# §2.10 baselines and folds
# ---------------------------------------------------------------------------

_BASE_SQL = {
    "persistence": "lag_1",
    "extrapolation": "greatest(lag_1 + (lag_1 - lag_2), 0.001)",
    "average": "(lag_1 + lag_2 + lag_3) / 3",
}

for _b, _e in _BASE_SQL.items():
    register(
        f"baseline_{_b}",
        with_ctes(f"SELECT city, date, target, {_e} AS y_pred FROM full_train", "full_train"),
        ["target", "y_pred"],
    )((lambda b: lambda spark, d: forecast.baseline_predictions(full(spark, d, "train"), b))(_b))

FOLD_CTES = {
    "dts": "SELECT date, row_number() OVER (ORDER BY date DESC) AS r FROM (SELECT DISTINCT date FROM full_train) t",
    "folds": """
SELECT CAST(f.fold AS BIGINT) AS fold, x.role, min(x.date) AS start, max(x.date) AS "end"
FROM range(1, 6) f(fold),
LATERAL (SELECT date, CASE WHEN r > (5 - f.fold) * 30 AND r <= (6 - f.fold) * 30 THEN 'test'
                           WHEN r > (6 - f.fold) * 30 + 7 THEN 'train' END AS role FROM dts) x
WHERE x.role IS NOT NULL GROUP BY f.fold, x.role""",
    "fscores": """
SELECT f.fold,
  sqrt(avg(power(t.target - t.lag_1, 2))) AS persistence,
  sqrt(avg(power(t.target - greatest(t.lag_1 + (t.lag_1 - t.lag_2), 0.001), 2))) AS extrapolation,
  sqrt(avg(power(t.target - (t.lag_1 + t.lag_2 + t.lag_3) / 3, 2))) AS average
FROM full_train t JOIN folds f ON f.role = 'test' AND t.date BETWEEN f.start AND f."end"
GROUP BY f.fold""",
    "cv": """
SELECT fold, 'persistence' AS baseline, persistence AS rmse FROM fscores
UNION ALL SELECT fold, 'extrapolation', extrapolation FROM fscores
UNION ALL SELECT fold, 'average', average FROM fscores""",
}


@register("time_folds", with_ctes("SELECT * FROM folds", "full_train", extra=FOLD_CTES))
def q_time_folds(spark, d):
    return forecast.time_folds(full(spark, d, "train"))


@register("baseline_crossval", with_ctes("SELECT * FROM cv", "full_train", extra=FOLD_CTES), ["rmse"])
def q_baseline_crossval(spark, d):
    # fold cut-offs and fold rows both read the features: one checkpointed copy
    # instead of the feature chain planned twice from the raw scans
    return forecast.baseline_crossval(shared(spark, d, "train"))


@register(
    "fold_summary",
    with_ctes("SELECT baseline, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse FROM cv GROUP BY baseline",
              "full_train", extra=FOLD_CTES),
    ["mean_rmse", "std_rmse"],
)
def q_fold_summary(spark, d):
    return forecast.fold_summary(forecast.baseline_crossval(shared(spark, d, "train")))


# ---------------------------------------------------------------------------
# §2.11 monitoring
# ---------------------------------------------------------------------------

def models(spark, d, f=None):
    f = shared(spark, d) if f is None else f
    return monitoring.candidate_models(f, schedule(spark, d, f))


def batch_scores(spark, d, f=None):
    f = shared(spark, d) if f is None else f
    tagged = joins.assign_batch(f, schedule(spark, d, f), ahead=config.HORIZON)
    return tagged.groupBy("batch", "batch_start", "batch_end").agg(
        stats.rmse_col("target", forecast.baseline_col("persistence")).alias("champion_rmse"),
        stats.rmse_col("target", forecast.baseline_col("extrapolation")).alias("challenger_rmse"),
    )


def batches(spark, d, f=None):
    f = shared(spark, d) if f is None else f
    return monitoring.batch_log(f, schedule(spark, d, f), models(spark, d, f))


MON_ALL = _mon(SCHED_CTES, PRED_CTES, MODEL_CTES, BATCH_CTES)


@register("batch_schedule", with_ctes("SELECT * FROM sched", "full_eval", extra=SCHED_CTES))
def q_batch_schedule(spark, d):
    return schedule(spark, d)


@register(
    "score_batches",
    with_ctes("""
SELECT s.batch, s.batch_start, s.batch_end, p.model_version,
  sqrt(avg(power(ln(1 + p.y_true) - ln(1 + p.y_pred), 2))) AS rmse, count(*) AS n_rows
FROM preds p JOIN sched s ON p.date BETWEEN s.batch_start AND s.batch_end
GROUP BY s.batch, s.batch_start, s.batch_end, p.model_version""", "full_eval", extra=_mon(SCHED_CTES, PRED_CTES)),
    ["rmse"],
)
def q_score_batches(spark, d):
    f = shared(spark, d)
    return monitoring.score_batches(predictions(spark, d, f), schedule(spark, d, f))


MODEL_DOUBLES = ["reference_rmse"]


@register("candidate_models", with_ctes("SELECT * FROM models", "full_eval", extra=MON_ALL), MODEL_DOUBLES)
def q_candidate_models(spark, d):
    return models(spark, d)


@register(
    "reference_lookup",
    with_ctes("""
SELECT s.batch, s.model_version, s.rmse, m.reference_rmse
FROM (SELECT s.batch, p.model_version, sqrt(avg(power(ln(1 + p.y_true) - ln(1 + p.y_pred), 2))) AS rmse
      FROM preds p JOIN sched s ON p.date BETWEEN s.batch_start AND s.batch_end - 1 GROUP BY s.batch, p.model_version) s
LEFT JOIN models m ON m.model_version = s.model_version""", "full_eval", extra=MON_ALL),
    ["rmse", "reference_rmse"],
)
def q_reference_lookup(spark, d):
    f = shared(spark, d)
    sc = monitoring.score_batches(predictions(spark, d, f), schedule(spark, d, f), config.HORIZON).select("batch", "model_version", "rmse")
    return joins.reference_lookup(sc, models(spark, d, f))


@register(
    "drift_check",
    with_ctes("""
SELECT s.batch, s.model_version, s.rmse, m.reference_rmse, s.rmse >= m.reference_rmse * 1.1 AS drift_detected
FROM (SELECT s.batch, p.model_version, sqrt(avg(power(ln(1 + p.y_true) - ln(1 + p.y_pred), 2))) AS rmse
      FROM preds p JOIN sched s ON p.date BETWEEN s.batch_start AND s.batch_end - 1 GROUP BY s.batch, p.model_version) s
LEFT JOIN models m ON m.model_version = s.model_version""", "full_eval", extra=MON_ALL),
    ["rmse", "reference_rmse"],
)
def q_drift_check(spark, d):
    f = shared(spark, d)
    sc = monitoring.score_batches(predictions(spark, d, f), schedule(spark, d, f), config.HORIZON).select("batch", "model_version", "rmse")
    return monitoring.drift_check(sc, models(spark, d, f))


@register(
    "promotion_check",
    with_ctes("""
SELECT s.batch, '1' AS champion_version, s.champion_rmse, '2' AS challenger_version,
  s.challenger_rmse AS rmse_challenger, s.challenger_rmse <= 0.99 * s.champion_rmse AS promote
FROM (SELECT x.batch, b.champion_rmse, b.challenger_rmse FROM bscore b JOIN sched x ON x.batch_start = b.batch_start) s""",
              "full_eval", extra=_mon(SCHED_CTES, BATCH_CTES)),
    ["champion_rmse", "rmse_challenger"],
)
def q_promotion_check(spark, d):
    s = batch_scores(spark, d)
    champ = s.select("batch", F.lit("1").alias("model_version"), F.col("champion_rmse").alias("rmse"))
    chall = s.select("batch", F.lit("2").alias("model_version"), F.col("challenger_rmse").alias("rmse"))
    return monitoring.promotion_check(champ, chall)


@register(
    "batch_log_view",
    with_ctes("""
SELECT batch_start, batch_end, champion_version, champion_rmse, coalesce(drift_detected, false) AS drift_detected,
  challenger_version, rmse_challenger, coalesce(promotion_applied, false) AS promotion_applied,
  CASE WHEN champion_rmse IS NULL OR champion_rmse = 0 THEN NULL
       ELSE 100 * (1 - rmse_challenger / champion_rmse) END AS pct_vs_prod
FROM batches ORDER BY batch_start DESC""", "full_eval", extra=MON_ALL),
    BATCH_DOUBLES + ["pct_vs_prod"],
)
def q_batch_log_view(spark, d):
    return monitoring.batch_log_view(batches(spark, d))


@register(
    "register_version",
    with_ctes("""
SELECT CAST(batch AS VARCHAR) AS model_version, train_start, train_end, batch_start AS eval_start,
  batch_end AS eval_end, CAST(NULL AS DOUBLE) AS reference_rmse,
  CASE WHEN batch = 1 THEN 'champion' WHEN batch = (SELECT max(batch) FROM sched) THEN 'challenger' ELSE 'archived' END AS alias
FROM sched""", "full_eval", extra=SCHED_CTES),
    MODEL_DOUBLES,
)
def q_register_version(spark, d):
    return registered_versions(spark, d)


def registered_versions(spark, d):
    s = schedule(spark, d)
    empty = spark.createDataFrame([], monitoring_schema_models())
    new = s.select(
        F.col("batch").cast("string").alias("model_version"),
        "train_start",
        "train_end",
        F.col("batch_start").alias("eval_start"),
        F.col("batch_end").alias("eval_end"),
        F.lit(None).cast("double").alias("reference_rmse"),
    )
    return monitoring.register_version(empty, new)


def monitoring_schema_models():
    from ..schemas import MODELS

    return MODELS


@register(
    "promote_challenger",
    with_ctes("""
SELECT model_version, train_start, train_end, eval_start, eval_end, reference_rmse,
  CASE alias WHEN 'champion' THEN 'archived' WHEN 'challenger' THEN 'champion' ELSE alias END AS alias
FROM models""", "full_eval", extra=MON_ALL),
    MODEL_DOUBLES,
)
def q_promote_challenger(spark, d):
    return monitoring.promote_challenger(models(spark, d))


@register(
    "load_by_alias",
    with_ctes("SELECT * FROM models WHERE alias = 'champion'", "full_eval", extra=MON_ALL),
    MODEL_DOUBLES,
)
def q_load_by_alias(spark, d):
    return monitoring.load_by_alias(models(spark, d))


@register(
    "update_alias",
    with_ctes("""
SELECT model_version, train_start, train_end, eval_start, eval_end, reference_rmse,
  CASE WHEN model_version = '3' THEN 'challenger' ELSE alias END AS alias
FROM models""", "full_eval", extra=MON_ALL),
    MODEL_DOUBLES,
)
def q_update_alias(spark, d):
    return monitoring.update_alias(models(spark, d), "3", "challenger")


@register(
    "prediction_view",
    with_ctes("""
SELECT city, min(date) AS date_start, max(date) AS date_end,
  sqrt(avg(power(ln(1 + y_true) - ln(1 + y_pred), 2))) AS rmsle FROM preds GROUP BY city""",
              "full_eval", extra=PRED_CTES),
    ["rmsle"],
)
def q_prediction_view(spark, d):
    return monitoring.prediction_view(predictions(spark, d))
