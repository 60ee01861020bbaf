"""Registered queries that go through files: JSON payload readers, CSV and
parquet storage, monitoring tables.

Each callable first writes Spark-derived data (from the driver's tables) to
a fresh folder under the session's shared checkpoint directory, then returns
the lazy DataFrame that reads it back through the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..plans import preprocess as pp
from ..session import scratch_path
from ..sources import fixtures, payload, storage
from ..sources.tables import table
from .registry import (
    BATCH_CTES,
    MODEL_CTES,
    PRED_CTES,
    ROLLUP_DOUBLES,
    SCHED_CTES,
    W_DOUBLES,
    _mon,
    batches,
    events,
    models,
    predictions,
    readings,
    register,
    schedule,
    shared,
    weather,
)
from .sql_prelude import with_ctes

# ---------------------------------------------------------------------------
# sensor payloads
# ---------------------------------------------------------------------------

def _rollup_with_periods(spark, d):
    from ..operators.rollup import daily_rollup

    r = daily_rollup(events(spark, d))
    return r.select("*", *payload.period_strings(F.col("date")))


@register(
    "scan_airqual_payload",
    with_ctes("""
SELECT sensor_id,
  strftime(CAST(date AS TIMESTAMP) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || 'Z' AS date_from_utc,
  strftime(CAST(date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') || '+02:00' AS date_from_local,
  strftime(CAST(date AS TIMESTAMP) + INTERVAL 22 HOUR, '%Y-%m-%dT%H:%M:%S') || 'Z' AS date_to_utc,
  strftime(CAST(date AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS date_to_local,
  pm25_avg, pm25_min, pm25_q25, pm25_median, pm25_q75, pm25_max, coverage, city, date
FROM (SELECT city, sensor_id, CAST(substr(ts_local, 1, 10) AS DATE) AS date,
        avg(value) AS pm25_avg, min(value) AS pm25_min, quantile_cont(value, 0.25) AS pm25_q25,
        quantile_cont(value, 0.5) AS pm25_median, quantile_cont(value, 0.75) AS pm25_q75, max(value) AS pm25_max,
        count(DISTINCT substr(ts_local, 12, 2)) * 100.0 / 24 AS coverage
      FROM events_raw GROUP BY 1, 2, 3) r""", "events_raw"),
    ROLLUP_DOUBLES,
)
def q_scan_airqual_payload(spark, d):
    root = scratch_path(spark, "sensor-payload")
    payload.pack_sensor_payloads(_rollup_with_periods(spark, d), root)
    return payload.scan_packed_payload(spark, root)


# ---------------------------------------------------------------------------
# stations
# ---------------------------------------------------------------------------

CITY_VALUES = ", ".join(
    f"({i}, '{n}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for i, (n, lat, lon) in enumerate(config.CITIES)
)
STATION_CTES = {
    "cities": f"SELECT * FROM (VALUES {CITY_VALUES}) c(idx, city, lat, lon)",
    "span": "SELECT l_suppkey, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1",
    "stations": f"""
SELECT c.city, s.s_suppkey AS id, s.s_acctbal > 0 AS is_monitor, span.first, span.last,
  c.lat + CAST((s.s_suppkey * 7919) % 2001 - 1000 AS DOUBLE) / 10000 AS latitude,
  c.lon + CAST((s.s_suppkey * 104729) % 2001 - 1000 AS DOUBLE) / 10000 AS longitude
FROM supplier s JOIN span ON s.s_suppkey = span.l_suppkey JOIN cities c ON s.s_nationkey % {len(config.CITIES)} = c.idx""",
}


def _project_bounds(spark, d):
    li = table(spark, d, "lineitem", "l_shipdate")
    r = li.agg(
        F.date_add(F.to_date(F.min("l_shipdate")), 180).alias("s"), F.date_sub(F.to_date(F.max("l_shipdate")), 180).alias("e")
    ).first()
    return r["s"], r["e"]


@register(
    "filter_stations",
    with_ctes("""
SELECT city, id AS station_id, id * 10 + 1 AS sensor_id FROM stations
WHERE is_monitor
  AND last >= CAST(CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE) - 180 AS TIMESTAMP)
  AND first <= CAST(CAST((SELECT min(l_shipdate) FROM lineitem) AS DATE) + 180 AS TIMESTAMP)""",
              "geo", extra=STATION_CTES),
)
def q_filter_stations(spark, d):
    root = scratch_path(spark, "station-payload")
    payload.write_station_payloads(fixtures.stations(spark, d), root)
    start, end = _project_bounds(spark, d)
    return payload.filter_stations(spark, root, start, end)


@register(
    "stations_in_radius",
    with_ctes(f"""
SELECT * FROM (
  SELECT c.city, s.id AS station_id,
    2 * 6371000.0 * asin(sqrt(power(sin((radians(s.latitude) - radians(c.lat)) / 2), 2)
      + cos(radians(c.lat)) * cos(radians(s.latitude)) * power(sin((radians(s.longitude) - radians(c.lon)) / 2), 2)))
      AS distance_m
  FROM cities c, stations s) t
WHERE distance_m <= {config.STATION_RADIUS_M}""", "geo", extra=STATION_CTES),
    ["distance_m"],
)
def q_stations_in_radius(spark, d):
    st = fixtures.stations(spark, d).select(F.col("id").alias("station_id"), "latitude", "longitude")
    return payload.stations_in_radius(fixtures.city_table(spark).select("city", "lat", "lon"), st)


# ---------------------------------------------------------------------------
# weather payloads
# ---------------------------------------------------------------------------

WX_PAYLOAD_SQL = """
SELECT date, temp_min, temp_max, (temp_min + temp_max) / 2 AS temp_avg, cloud_cover, humidity, precipitation,
  pressure, wind_speed, wind_direction, city FROM weather"""


def _weather_payload_root(spark, d):
    root = scratch_path(spark, "weather-payload")
    payload.write_weather_payloads(weather(spark, d), root)
    return root


@register("scan_weather_payload", with_ctes(WX_PAYLOAD_SQL, "weather"), W_DOUBLES + ["temp_avg"])
def q_scan_weather_payload(spark, d):
    return payload.scan_weather_payload(spark, _weather_payload_root(spark, d))


@register(
    "merge_weather_files",
    with_ctes(WX_PAYLOAD_SQL + """
WHERE date BETWEEN (SELECT min(date) + 365 FROM weather) AND (SELECT max(date) - 365 FROM weather)""", "weather"),
    W_DOUBLES + ["temp_avg"],
)
def q_merge_weather_files(spark, d):
    w = weather(spark, d)
    b = w.agg(F.date_add(F.min("date"), 365).alias("s"), F.date_sub(F.max("date"), 365).alias("e")).first()
    return payload.merge_weather_files(spark, _weather_payload_root(spark, d), b["s"], b["e"])


@register(
    "quarantine_bad_weather",
    with_ctes("""
SELECT city, count(*) FILTER (WHERE kind >= 2) AS good_payloads, count(*) FILTER (WHERE kind = 0) AS unparsable,
  count(*) FILTER (WHERE kind = 1) AS key_missing,
  sum(temp_max) FILTER (WHERE kind >= 2) AS temp_max_sum
FROM (SELECT *, (date_diff('day', DATE '1970-01-01', date) * 31 + length(city)) % 9 AS kind FROM weather) w GROUP BY city""", "weather"),
    ["temp_max_sum"],
)
def q_quarantine_bad_weather(spark, d):
    """Payloads of which some days' are cut short (unparsable) and some lack a key.

    The damage is done to the written lines, by day and city; the reader sees files only.
    """
    clean_root, root = _weather_payload_root(spark, d), scratch_path(spark, "weather-damaged")
    lines = spark.read.option("basePath", clean_root).text(clean_root)  # one payload per line, and its city
    day = F.to_date(F.get_json_object("value", "$.date"))
    kind = (F.datediff(day, F.lit("1970-01-01").cast("date")) * 31 + F.length("city")) % 9
    cut = F.expr("substring(value, 1, length(value) - 5)")
    lacking = F.regexp_replace("value", '"pressure":\\{[^}]*\\},?', "")
    damaged = lines.withColumn("value", F.when(kind == 0, cut).when(kind == 1, lacking).otherwise(F.col("value")))
    damaged.write.partitionBy("city").text(root)
    good, bad = payload.quarantine_bad_weather(spark, root)
    kept = good.groupBy("city").agg(F.count(F.lit(1)).alias("good_payloads"), F.sum("temperature.max").alias("temp_max_sum"))
    refused = bad.groupBy("city").agg(
        F.count("_corrupt_record").alias("unparsable"), F.count_if(F.col("_corrupt_record").isNull()).alias("key_missing"))
    none = F.lit(0).cast("long")
    return kept.join(refused, "city", "full").select(
        "city", F.coalesce("good_payloads", none).alias("good_payloads"), F.coalesce("unparsable", none).alias("unparsable"),
        F.coalesce("key_missing", none).alias("key_missing"), "temp_max_sum")


# ---------------------------------------------------------------------------
# storage
# ---------------------------------------------------------------------------

_CSV_WEATHER = W_DOUBLES + ["temp_avg"]
_CSV_FEATURES = [f for f in config.SELECTED_FEATURES if f != "city"] + ["target"]


def _long(names: list[str]) -> str:
    return f"date, city, unnest([{', '.join(repr(n) for n in names)}]) AS name, unnest([{', '.join(f'{n}::DOUBLE' for n in names)}]) AS value"


@register(
    "csv_roundtrip",
    with_ctes(f"""
SELECT 'weather' AS data_type, {_long(_CSV_WEATHER)} FROM weather
UNION ALL
SELECT 'processed', {_long(_CSV_FEATURES)} FROM full_eval""", "weather", "full_eval"),
    ["value"],
)
def q_csv_roundtrip(spark, d):
    """Weather and processed rows saved and read back with their fixed schemas; one row a number."""
    root, out = scratch_path(spark, "csv"), None
    w = weather(spark, d)
    for data_type, rows, names in (("weather", w, _CSV_WEATHER), ("processed", pp.preprocess_eval(readings(spark, d), w), _CSV_FEATURES)):
        storage.save_csv(rows, root, data_type)
        back = storage.load_csv(spark, root, data_type)
        if back.schema != storage.DATA_TYPES[data_type]:
            raise RuntimeError(f"{data_type}: read back as {back.schema.simpleString()}")
        part = back.unpivot(["date", "city"], names, "name", "value").withColumn("data_type", F.lit(data_type))
        out = part if out is None else out.unionByName(part)
    return out


def _bounds(spark, d):
    w = weather(spark, d)
    r = w.agg(F.date_add(F.min("date"), 365).alias("s"), F.date_sub(F.max("date"), 365).alias("e")).first()
    return r["s"], r["e"]


def _weather_table(spark, d):
    root = scratch_path(spark, "weather-table")
    storage.write_table(weather(spark, d), root, partition_by="date")
    return root


@register(
    "scan_range",
    with_ctes("""
SELECT * FROM weather
WHERE date BETWEEN (SELECT min(date) + 365 FROM weather) AND (SELECT max(date) - 365 FROM weather)""", "weather"),
    W_DOUBLES + ["temp_avg"],
)
def q_scan_range(spark, d):
    root = _weather_table(spark, d)
    s, e = _bounds(spark, d)
    return storage.scan_range(spark, root, s, e, order=True)


@register(
    "range_replace",
    with_ctes("""
SELECT * FROM weather
WHERE date NOT BETWEEN (SELECT min(date) + 365 FROM weather) AND (SELECT max(date) - 365 FROM weather)
UNION ALL
SELECT date, temp_min, temp_max + 1 AS temp_max, temp_avg, cloud_cover, humidity, precipitation, pressure,
  wind_speed, wind_direction, city FROM weather
WHERE date BETWEEN (SELECT min(date) + 365 FROM weather) AND (SELECT max(date) - 730 FROM weather)""", "weather"),
    W_DOUBLES + ["temp_avg"],
)
def q_range_replace(spark, d):
    """Replace [min+365, max-365] with shifted rows of a shorter range, twice:
    the second run must leave the same table (idempotent), and dates of the
    range that the new load lacks must be gone."""
    root = _weather_table(spark, d)
    s, e = _bounds(spark, d)
    w = weather(spark, d)
    import datetime as dt

    short_end = e - dt.timedelta(days=365)
    new = w.filter(F.col("date").between(s, short_end)).withColumn("temp_max", F.col("temp_max") + 1)
    storage.range_replace(spark, root, new, s, e)
    storage.range_replace(spark, root, new, s, e)
    return storage.read_table(spark, root)


@register(
    "exists_range",
    with_ctes("""
SELECT count(*) FILTER (WHERE date BETWEEN (SELECT max(date) - 30 FROM weather) AND (SELECT max(date) FROM weather)) > 0
         AS in_range,
       count(*) FILTER (WHERE date > (SELECT max(date) FROM weather)) > 0 AS after_end,
       false AS missing_table
FROM weather""", "weather"),
)
def q_exists_range(spark, d):
    import datetime as dt

    root = _weather_table(spark, d)
    hi = weather(spark, d).agg(F.max("date")).first()[0]
    a = storage.exists_range(spark, root, hi - dt.timedelta(days=30), hi)
    b = storage.exists_range(spark, root, hi + dt.timedelta(days=1), hi + dt.timedelta(days=400))
    c = storage.exists_range(spark, scratch_path(spark, "absent"), hi, hi)
    return spark.createDataFrame([(a, b, c)], "in_range boolean, after_end boolean, missing_table boolean")


# ---------------------------------------------------------------------------
# monitoring tables
# ---------------------------------------------------------------------------

MON_ALL = _mon(SCHED_CTES, PRED_CTES, MODEL_CTES, BATCH_CTES)


@register(
    "log_batch",
    with_ctes("""
SELECT * REPLACE (CASE WHEN (b.batch_start - (SELECT min(batch_start) FROM batches)) // 42 % 2 = 0 THEN champion_rmse ELSE champion_rmse + 1 END AS champion_rmse)
FROM batches b""", "full_eval", extra=MON_ALL),
    ["champion_rmse", "rmse_challenger"],
)
def q_log_batch(spark, d):
    """All batches logged one by one with another score, then every second one again with
    its own: a batch's row is replaced by its window, the others stay."""
    root = scratch_path(spark, "batch-log")
    rows = batches(spark, d).checkpoint()
    starts = [r[0] for r in rows.select("batch_start").orderBy("batch_start").collect()]  # one row per batch (6)
    for s in starts:
        storage.log_batch(spark, root, rows.filter(F.col("batch_start") == s).withColumn("champion_rmse", F.col("champion_rmse") + 1))
    for s in starts[::2]:
        storage.log_batch(spark, root, rows.filter(F.col("batch_start") == s))
    return storage.read_table(spark, root)


@register(
    "log_predictions",
    with_ctes("""
SELECT p.date, p.city, p.y_true, p.y_pred, p.model_version
FROM preds p JOIN sched s ON p.date BETWEEN s.batch_start AND s.batch_end""", "full_eval",
              extra=_mon(SCHED_CTES, PRED_CTES)),
    ["y_true", "y_pred"],
)
def q_log_predictions(spark, d):
    """Each batch's predictions logged in turn (range replace by the rows'
    own date bounds), the last batch twice; the table then holds every batch once."""
    root = scratch_path(spark, "predictions")
    f = shared(spark, d)
    preds = predictions(spark, d, f)
    sched = schedule(spark, d, f).collect()  # one row per batch (6)
    for b in sorted(sched, key=lambda r: r["batch"]) + [max(sched, key=lambda r: r["batch"])]:
        part = pp.evaluation_slice(preds, b["batch_start"], b["batch_end"])
        storage.log_predictions(spark, root, part)
    return storage.read_table(spark, root)


@register(
    "upsert_model",
    with_ctes("""
SELECT model_version, train_start, train_end, eval_start, eval_end,
  CASE WHEN model_version = '2' THEN reference_rmse * 2 ELSE reference_rmse END AS reference_rmse, alias
FROM models""", "full_eval", extra=MON_ALL),
    ["reference_rmse"],
)
def q_upsert_model(spark, d):
    root = scratch_path(spark, "models")
    m = models(spark, d)
    storage.write_table(m, root)
    changed = m.filter(F.col("model_version") == "2").withColumn("reference_rmse", F.col("reference_rmse") * 2)
    _, n_deleted = storage.upsert_model(spark, root, changed)
    if n_deleted > 1:
        raise RuntimeError(f"{n_deleted} rows replaced for one model version")
    return storage.read_table(spark, root)


@register("read_monitoring", with_ctes("SELECT * FROM batches", "full_eval", extra=MON_ALL),
          ["champion_rmse", "rmse_challenger"])
def q_read_monitoring(spark, d):
    root = scratch_path(spark, "batches")
    b = batches(spark, d)
    storage.log_batch(spark, root, b)
    storage.log_batch(spark, root, b.filter(F.col("drift_detected")))  # re-logging batches replaces them
    return storage.read_table(spark, root)

