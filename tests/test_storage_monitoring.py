import datetime as dt

import pytest
from pyspark.sql import functions as F

from smogline import schemas
from smogline.catalog import registry, registry_io
from smogline.operators import joins
from smogline.plans import monitoring
from smogline.plans import preprocess as pp
from smogline.session import scratch_path
from smogline.sources import payload, storage


def wx(spark, days, bump=0.0, start="2024-01-01"):
    d0 = dt.date.fromisoformat(start)
    rows = [(d0 + dt.timedelta(days=i), 1.0 + bump, "A") for i in range(days)]
    return spark.createDataFrame(rows, "date date, temp_max double, city string")


def test_range_replace_idempotent_and_drops_stale_dates(spark):
    root = scratch_path(spark, "t-range")
    storage.range_replace(spark, root, wx(spark, 30), "2024-01-01", "2024-01-30")
    new = wx(spark, 5, bump=1.0, start="2024-01-10")  # shorter load inside [10, 20]
    storage.range_replace(spark, root, new, "2024-01-10", "2024-01-20")
    once = sorted(storage.read_table(spark, root).collect())
    storage.range_replace(spark, root, new, "2024-01-10", "2024-01-20")
    twice = sorted(storage.read_table(spark, root).collect())
    assert once == twice
    dates = {r.date for r in twice}
    assert dt.date(2024, 1, 16) not in dates and dt.date(2024, 1, 14) in dates
    assert len(twice) == 30 - 11 + 5
    assert storage.exists_range(spark, root, "2024-01-29", "2024-02-05")
    assert not storage.exists_range(spark, root, "2024-03-01", "2024-03-05")
    assert not storage.exists_range(spark, scratch_path(spark, "none"), "2024-01-01", "2024-01-02")
    assert storage.scan_range(spark, root, "2024-01-01", "2024-01-05").count() == 5


def test_key_replace_counts_deleted(spark):
    root = scratch_path(spark, "t-keys")
    rows = [("1", None, None, None, None, 0.5, "champion"), ("2", None, None, None, None, 0.6, "challenger")]
    storage.write_table(spark.createDataFrame(rows, schemas.MODELS), root)
    upd = spark.createDataFrame([("2", None, None, None, None, 0.9, "challenger")], schemas.MODELS)
    _, n = storage.upsert_model(spark, root, upd)
    assert n == 1
    got = {r.model_version: r.reference_rmse for r in storage.read_table(spark, root).collect()}
    assert got == {"1": 0.5, "2": 0.9}


def test_csv_roundtrip_and_errors(spark):
    root = scratch_path(spark, "t-csv")
    df = wx(spark, 3)
    full = spark.createDataFrame(
        [(r.date, 1.0, 2.0, 1.5, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, r.city) for r in df.collect()], schemas.WEATHER
    )
    storage.save_csv(full, root, "weather")
    back = storage.load_csv(spark, root, "weather")
    assert sorted(back.collect()) == sorted(full.collect())
    with pytest.raises(ValueError):
        storage.save_csv(full, root, "other")
    with pytest.raises(FileNotFoundError):
        storage.load_csv(spark, scratch_path(spark, "none"), "weather").collect()


def models_df(spark, aliases):
    rows = [(str(i + 1), None, None, None, None, None, a) for i, a in enumerate(aliases)]
    return spark.createDataFrame(rows, schemas.MODELS)


def test_promotion_transitions(spark):
    m = monitoring.promote_challenger(models_df(spark, ["champion", "challenger", "archived"]))
    assert [r.alias for r in m.orderBy("model_version").collect()] == ["archived", "champion", "archived"]
    m2 = monitoring.promote_challenger(models_df(spark, ["challenger"]))
    assert [r.alias for r in m2.collect()] == ["champion"]


def test_register_version_first_is_champion(spark):
    empty = spark.createDataFrame([], schemas.MODELS)
    new = models_df(spark, [None, None]).drop("alias")
    m = monitoring.register_version(empty, new)
    assert [r.alias for r in m.orderBy("model_version").collect()] == ["champion", "challenger"]
    m3 = monitoring.register_version(m, models_df(spark, [None, None, None]).drop("alias").filter("model_version = '3'"))
    assert m3.filter("model_version = '3'").first().alias == "challenger"
    assert [r.alias for r in m3.orderBy("model_version").collect()] == ["champion", "archived", "challenger"]  # an alias has one holder
    m4 = monitoring.promote_challenger(m3, "3")
    assert [r.alias for r in m4.orderBy("model_version").collect()] == ["archived", "archived", "champion"]
    assert [r.alias for r in monitoring.promote_challenger(m4).orderBy("model_version").collect()] == ["archived", "archived", "champion"]
    ten = spark.createDataFrame([(v, None, None, None, None, None) for v in ("10", "9")], m.drop("alias").schema)
    assert {r.model_version: r.alias for r in monitoring.register_version(empty, ten).collect()} == {"9": "champion", "10": "challenger"}
    with pytest.raises(ValueError):
        monitoring.update_alias(m, "1", "boss")


def test_drift_and_promotion_are_inclusive(spark):
    df = spark.createDataFrame([(1.1, 1.0, 0.99, 1.0)], "new double, ref double, chall double, champ double")
    from smogline import functions as fx

    r = df.select(fx.drift_flag("new", "ref").alias("d"), fx.promotion_flag("chall", "champ").alias("p")).first()
    # 1.0 * 1.1 = 1.1 and 0.99 * 1.0 = 0.99 exactly representable comparisons hold inclusively
    assert r.p is True
    df2 = spark.createDataFrame([(1.25, 1.0)], "new double, ref double")
    assert df2.select(fx.drift_flag("new", "ref", margin=25).alias("d")).first().d is True


def test_batch_schedule_and_assignment(spark):
    days = spark.range(0, 400).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"))
    s = monitoring.batch_schedule(days).orderBy("batch").collect()
    assert len(s) == 6 and s[-1].batch_end == dt.date(2021, 2, 3)
    assert all((r.batch_end - r.batch_start).days == 41 for r in s)
    assert all(r.train_end == r.batch_start - dt.timedelta(days=1) for r in s)
    tagged = joins.assign_batch(days, monitoring.batch_schedule(days))
    assert tagged.count() == 6 * 42
    with pytest.raises(ValueError):
        monitoring.batch_by_number(monitoring.batch_schedule(days), 9)


def test_weather_quarantine(spark, tmp_path):
    root = scratch_path(spark, "t-wx")
    good = '{"date": "2024-01-01", "temperature": {"min": 1, "max": 3}, "cloud_cover": {"afternoon": 1}, ' \
           '"humidity": {"afternoon": 1}, "precipitation": {"total": 0}, "pressure": {"afternoon": 1000}, ' \
           '"wind": {"max": {"speed": 3, "direction": 90}}}'
    no_wind = good.replace(', "wind": {"max": {"speed": 3, "direction": 90}}', "")
    broken = '{"date": "2024-01-03", "temperature": '
    spark.createDataFrame([(good,), (no_wind,), (broken,)], "value string").coalesce(1).write.text(f"{root}/city=X")
    ok, bad = payload.quarantine_bad_weather(spark, root)
    assert ok.count() == 1 and bad.count() == 2
    flat = payload.scan_weather_payload(spark, root).first()
    assert flat.temp_avg == 2.0 and flat.wind_speed == 3.0 and flat.city == "X"


def test_stations_in_radius_grid_matches_brute_force(spark):
    cities = spark.createDataFrame([("P", 48.86, 2.35), ("N", 70.0, 20.0)], "city string, lat double, lon double")
    import random

    rnd = random.Random(5)
    st = [(i, 48.86 + rnd.uniform(-0.2, 0.2), 2.35 + rnd.uniform(-0.3, 0.3)) for i in range(300)]
    st += [(1000 + i, 70.0 + rnd.uniform(-0.1, 0.1), 20.0 + rnd.uniform(-0.4, 0.4)) for i in range(300)]
    stations = spark.createDataFrame(st, "station_id long, latitude double, longitude double")
    got = {(r.city, r.station_id) for r in payload.stations_in_radius(cities, stations, 7000).collect()}
    pairs = cities.crossJoin(stations)  # brute force reference on a tiny fixture
    d = payload.haversine_m(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))
    ref = {(r.city, r.station_id) for r in pairs.filter(d <= 7000).collect()}
    assert got == ref and len(ref) > 10


def test_range_replace_rewrites_only_touched_months(spark):
    root = scratch_path(spark, "t-months")
    storage.range_replace(spark, root, wx(spark, 90, start="2024-01-01"), "2024-01-01", "2024-03-30")
    first = storage._current(spark, root)
    assert len(first["paths"]) == 3  # Jan, Feb, Mar
    storage.range_replace(spark, root, wx(spark, 10, bump=1.0, start="2024-02-05"), "2024-02-01", "2024-02-29")
    second = storage._current(spark, root)
    jan = [p for p in second["paths"] if "_month=2024-01-01" in p]
    feb = [p for p in second["paths"] if "_month=2024-02-01" in p]
    assert jan and all(first["version"] in p for p in jan)  # carried, not rewritten
    assert feb and all(second["version"] in p for p in feb)  # rewritten
    t = storage.read_table(spark, root)
    assert t.filter("date between '2024-02-01' and '2024-02-29'").count() == 10
    assert t.count() == 90 - 29 + 10
    assert storage.scan_range(spark, root, "2024-03-01", "2024-03-31").count() == 30


def test_sensor_payload_scan_and_station_filter(spark):
    import datetime as dt2

    root = scratch_path(spark, "t-aq")
    one = ('{"meta": {"found": 1}, "results": [{"period": {"datetimeFrom": {"utc": "2024-01-01T22:00:00Z", '
           '"local": "2024-01-02T00:00:00+02:00"}, "datetimeTo": {"utc": "2024-01-02T22:00:00Z", '
           '"local": "2024-01-03T00:00:00+02:00"}}, "value": 12.5, "summary": {"min": 1, "q25": 5, "median": 10, '
           '"q75": 15, "max": 30}, "coverage": {"percentComplete": 95.8}}]}')
    empty = '{"meta": {"found": 0}, "results": []}'
    spark.createDataFrame([(one,)], "value string").coalesce(1).write.text(f"{root}/city=Paris/sensor_id=7")
    spark.createDataFrame([(empty,)], "value string").coalesce(1).write.text(f"{root}/city=Paris/sensor_id=8")
    rows = payload.scan_airqual_payload(spark, root).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.city, r.sensor_id, r.pm25_avg, r.pm25_q75) == ("Paris", 7, 12.5, 15.0)
    assert r.date == dt2.date(2024, 1, 2)  # local calendar day, not the UTC one

    st_root = scratch_path(spark, "t-st")
    sensors = "array<struct<id:bigint,parameter:struct<id:int>>>"
    stations = spark.createDataFrame(
        [
            ("Paris", 1, True, "2020-01-01T00:00:00Z", "2025-01-01T00:00:00Z", 48.0, 2.0, [(11, (2,)), (12, (1,))]),
            ("Paris", 2, False, "2020-01-01T00:00:00Z", "2025-01-01T00:00:00Z", 48.0, 2.0, [(21, (2,))]),
            ("Paris", 3, True, "2023-06-01T00:00:00Z", "2025-01-01T00:00:00Z", 48.0, 2.0, [(31, (2,))]),
        ],
        f"city string, id bigint, isMonitor boolean, first_utc string, last_utc string, latitude double, "
        f"longitude double, sensors {sensors}",
    )
    payload.write_station_payloads(stations, st_root)
    got = [(r.station_id, r.sensor_id) for r in payload.filter_stations(spark, st_root, "2023-05-01", "2024-12-31").collect()]
    assert got == [(1, 11)]  # monitor, active over the whole span, PM2.5 sensor only


def test_storage_keeps_what_it_should(spark):
    d = lambda x: None if x is None else dt.date.fromisoformat(x)
    frame = lambda rows: spark.createDataFrame([(d(a), k, v) for a, k, v in rows], "date date, k string, v double")
    root = scratch_path(spark, "keeps")
    storage.write_table(frame([(None, "n", 0.0), ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0), ("2024-03-01", "b", 3.0)]), root, "date")
    storage.range_replace(spark, root, frame([("2024-01-02", "z", 9.0)]), "2024-01-02", "2024-01-02")
    assert sorted(r.k for r in storage.read_table(spark, root).collect()) == ["a", "b", "n", "z"]
    march = [p for p in storage._current(spark, root)["paths"] if "2024-03" in p]
    storage.key_replace_months(spark, root, frame([("2024-01-01", "a", 7.0)]), ["date", "k"])
    assert {r.k: r.v for r in storage.read_table(spark, root).collect()} == {"a": 7.0, "b": 3.0, "n": 0.0, "z": 9.0}
    assert [p for p in storage._current(spark, root)["paths"] if "2024-03" in p] == march  # carried over, not rewritten
    before = storage.read_table(spark, root).count()
    with pytest.raises(ValueError):
        storage.log_predictions(spark, root, frame([]))
    assert storage.read_table(spark, root).count() == before


def test_key_replace_rewrites_only_the_days_it_touches(spark):
    d = lambda x: None if x is None else dt.date.fromisoformat(x)
    frame = lambda rows: spark.createDataFrame([(d(a), k, v) for a, k, v in rows], "date date, k string, v double")
    root = scratch_path(spark, "by-day")
    paths = lambda: storage._current(spark, root)["paths"]
    content = lambda: sorted((str(r.date), r.k, r.v) for r in storage.read_table(spark, root).collect())
    # a month-wise table goes on day by day; its untouched months stay
    storage.write_table(frame([(None, "n", 0.0), ("2023-11-30", "a", 1.0), ("2024-01-01", "a", 1.0)]), root, "date")
    november = [p for p in paths() if "2023-11" in p]
    storage.key_replace_days(spark, root, frame([("2024-01-01", "b", 2.0), ("2024-01-02", "a", 3.0), ("2024-01-03", "a", 4.0)]), ["date", "k"])
    held = {p.rsplit("=")[-1]: p for p in paths()}
    assert {"2024-01-01", "2024-01-02", "2024-01-03"} < set(held) and set(november) < set(paths())
    version = storage.key_replace_days(spark, root, frame([("2024-01-03", "a", 5.0), ("2024-01-04", "a", 6.0)]), ["date", "k"])
    assert {held["2024-01-01"], held["2024-01-02"], *november} < set(paths()) and held["2024-01-03"] not in paths()
    assert storage.key_replace_days(spark, root, frame([]), ["date", "k"]) == version
    # a later month closes January: its days become one folder; a late row rewrites that
    storage.key_replace_days(spark, root, frame([("2024-02-01", "a", 7.0)]), ["date", "k"])
    assert sum("2024-01" in p for p in paths()) == 1 and set(november) < set(paths())
    storage.key_replace_days(spark, root, frame([("2024-01-02", "a", 8.0)]), ["date", "k"])
    assert content() == [("2023-11-30", "a", 1.0), ("2024-01-01", "a", 1.0), ("2024-01-01", "b", 2.0), ("2024-01-02", "a", 8.0),
                         ("2024-01-03", "a", 5.0), ("2024-01-04", "a", 6.0), ("2024-02-01", "a", 7.0), ("None", "n", 0.0)]
    assert [r.k for r in storage.scan_range(spark, root, "2024-01-04", "2024-02-01", order=True).collect()] == ["a", "a"]
    storage.range_replace(spark, root, frame([("2024-01-03", "z", 9.0)]), "2024-01-02", "2024-01-31")
    assert [r[1:] for r in content() if r[0] >= "2024-01"] == [("a", 1.0), ("b", 2.0), ("z", 9.0), ("a", 7.0), ("n", 0.0)]


def test_union_without_rows_is_refused(spark):
    from smogline.operators.rollup import union_sources

    one = spark.createDataFrame([("A", 1)], "city string, sensor_id long")
    none = one.where("false")
    assert union_sources([none, one]).count() == 1
    for frames in ([], [none], [none, none]):
        with pytest.raises(ValueError, match="no data in any source"):
            union_sources(frames)


def test_processed_csv_keeps_its_types(spark):
    from smogline import config, schemas

    root = scratch_path(spark, "t-processed")
    schema = storage.DATA_TYPES["processed"]
    row = tuple("A" if f.name == "city" else dt.date(2024, 1, 1) if f.name == "date" else 1.0 for f in schema)
    empty = tuple("B" if f.name == "city" else dt.date(2024, 1, 2) if f.name == "date" else None for f in schema)
    df = spark.createDataFrame([row, empty], schema)  # whole numbers and nulls only: inference would see integers and text
    storage.save_csv(df, root, "processed")
    back = storage.load_csv(spark, root, "processed")
    assert back.schema == schema and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    wide = schemas.processed(config.features_for("all_lags_14"))
    with pytest.raises(Exception):  # noqa: B017  other columns than the header's
        storage.load_csv(spark, root, "processed", schema=wide).collect()


def test_packed_payloads(spark):
    from smogline.operators.rollup import ROLLUP_KEYS

    rows = [("Paris" if s % 2 else "Lyon", s, dt.date(2024, 1, 1) + dt.timedelta(days=k), *[float(s + k + i) for i in range(6)], 50.0) for s in range(60) for k in range(5)]
    cols = [*ROLLUP_KEYS, "pm25_avg", "pm25_min", "pm25_q25", "pm25_median", "pm25_q75", "pm25_max", "coverage"]
    daily = spark.createDataFrame(rows, cols).select("*", *payload.period_strings(F.col("date")))
    single, packed = scratch_path(spark, "t-single"), scratch_path(spark, "t-packed")
    payload.write_sensor_payloads(daily, single)
    payload.pack_sensor_payloads(daily, packed, file_bytes=20_000)
    want = sorted(payload.scan_airqual_payload(spark, single).collect())
    assert sorted(payload.scan_packed_payload(spark, packed).collect()) == want and len(want) == 300
    # files follow the bytes, not the 60 sensors
    manifest = spark.read.parquet(f"{packed}/manifest")
    total = manifest.agg(F.sum("bytes")).first()[0]
    assert total / 20_000 / 2 < manifest.count() <= total / 20_000 + 1 < 60
    assert manifest.agg(F.sum("payloads")).first()[0] == 60
    # a sensor's scan reads one file; an unknown one reads none
    one = payload.scan_packed_payload(spark, packed, [17])
    assert len(one.inputFiles()) == 1 and sorted(one.collect()) == [r for r in want if r.sensor_id == 17]
    assert payload.scan_packed_payload(spark, packed, [999]).count() == 0 and payload.scan_packed_payload(spark, packed, []).count() == 0
    payload.pack_sensor_payloads(daily.where("false"), packed + "-none")
    assert payload.scan_packed_payload(spark, packed + "-none", [1]).count() == 0


def _batch_features(spark):
    """Two cities, 400 days: six batches of 42 days, each day's target known."""
    return spark.range(0, 400).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"), F.explode(F.array(F.lit("A"), F.lit("B"))).alias("city"),
        (F.col("id") % 7 + 1.0).alias("target"), (F.col("id") % 5 + 1.0).alias("lag_1"))


def test_evaluation_slice_holds_the_whole_window(spark):
    f = _batch_features(spark)
    lo, hi = dt.date(2020, 3, 1), dt.date(2020, 4, 11)
    assert pp.evaluation_slice(f, lo, hi).count() == 2 * 42
    assert pp.evaluation_slice(f, lo, hi).agg(F.max("date")).first()[0] == hi
    assert pp.evaluation_slice(f, lo, hi, ahead=1).agg(F.max("date")).first()[0] == hi - dt.timedelta(days=1)


def test_score_batches_takes_every_day_of_a_batch(spark):
    f = _batch_features(spark)
    s, p = monitoring.batch_schedule(f.select("date")), monitoring.persistence_predictions(f)
    assert [r.n_rows for r in monitoring.score_batches(p, s).collect()] == [2 * 42] * 6
    assert [r.n_rows for r in monitoring.score_batches(p, s, ahead=1).collect()] == [2 * 41] * 6


def test_log_predictions_logs_every_day_of_a_batch(spark, monkeypatch):
    f = _batch_features(spark)
    monkeypatch.setattr(registry, "full", lambda *a: f)
    rows = registry_io.q_log_predictions(spark, None)
    assert rows.count() == rows.select("date", "city").distinct().count() == 6 * 42 * 2
