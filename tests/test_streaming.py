import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.operators.rollup import daily_rollup
from smogline.session import scratch_path
from smogline.sources.fixtures import local_stamp
from smogline.streaming.rollup import stream_daily_rollup, write_arrivals


def test_stream_rollup_equals_batch_rollup(spark):
    rng = np.random.default_rng(9)
    base = dt.datetime(2024, 3, 1)
    rows = [
        ("c", int(rng.integers(1, 4)), i, base + dt.timedelta(minutes=int(m)), float(rng.uniform(1, 50)))
        for i, m in enumerate(sorted(rng.integers(0, 10 * 1440, 1500)))
    ]
    raw = spark.createDataFrame(rows, "city string, sensor_id long, event_id long, ts timestamp, value double")
    raw = raw.withColumn("ts_local", local_stamp(F.col("ts")))
    src = scratch_path(spark, "t-stream-src")
    out_root, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-ckpt")
    write_arrivals(raw, src, slices=4, on_arrival=lambda _: stream_daily_rollup(spark, f"{src}/slice=*", out_root, ckpt))
    from smogline.sources import storage

    out = storage.read_table(spark, out_root)
    got = {(r.city, r.sensor_id, r.date): r for r in out.collect()}
    ref = {(r.city, r.sensor_id, r.date): r for r in daily_rollup(raw).collect()}
    assert set(got) == set(ref)
    for k, r in ref.items():
        g = got[k]
        assert g.n_readings == r.n_readings
        assert g.pm25_min == r.pm25_min and g.pm25_max == r.pm25_max
        assert g.pm25_avg == pytest.approx(r.pm25_avg, rel=1e-12)
        for c in ("pm25_q25", "pm25_median", "pm25_q75", "coverage"):
            assert g[c] == pytest.approx(r[c], rel=1e-12), c


def test_late_rows_count_until_the_watermark_has_passed(spark):
    """A late row inside the watermark changes its day's quantiles and hours; one behind it changes nothing."""
    src, out_root, ckpt = (scratch_path(spark, f"t-late-{x}") for x in ("src", "out", "ckpt"))
    day = dt.datetime(2024, 5, 10, 6)
    arrivals = [
        [(day, 10.0), (day + dt.timedelta(hours=3), 20.0)],
        [(day + dt.timedelta(days=1), 1.0)],
        [(day + dt.timedelta(hours=5), 60.0)],  # late, its day still open
        [(day + dt.timedelta(days=9), 1.0)],
        [(day + dt.timedelta(days=10), 1.0)],  # the first day is closed now
        [(day + dt.timedelta(hours=7), 1000.0)],
    ]
    for i, part in enumerate(arrivals):
        rows = [("c", 1, 10 * i + k, ts, v) for k, (ts, v) in enumerate(part)]
        raw = spark.createDataFrame(rows, "city string, sensor_id long, event_id long, ts timestamp, value double")
        raw.withColumn("ts_local", local_stamp(F.col("ts"))).write.parquet(f"{src}/slice={i:03d}")
        table = stream_daily_rollup(spark, f"{src}/slice=*", out_root, ckpt)
    first = table.where("date = '2024-05-10'").first()
    assert (first.n_readings, first.pm25_q25, first.pm25_median, first.pm25_q75, first.pm25_max) == (3, 15.0, 20.0, 40.0, 60.0)
    assert first.coverage == pytest.approx(3 * 100 / 24)


def test_arrivals_hold_every_row_once(spark):
    """Rows on a bound go to the later slice, the last one keeps the end, an empty slice arrives too; no row without a time."""
    day = dt.datetime(2024, 3, 1)
    rows = [(i, None if h is None else day + dt.timedelta(hours=h)) for i, h in enumerate([0, 1, 2, 6, 7, 8, 8, None])]
    root, seen = scratch_path(spark, "t-arrivals"), []
    paths = write_arrivals(spark.createDataFrame(rows, "event_id long, ts timestamp"), root, slices=4, on_arrival=lambda p: seen.append(
        sorted(r.event_id for r in spark.read.parquet(f"{root}/slice=*").collect())))
    assert [sorted(r.event_id for r in spark.read.parquet(p).collect()) for p in paths] == [[0, 1], [2], [], [3, 4, 5, 6]]
    assert seen == [[0, 1], [0, 1, 2], [0, 1, 2], [0, 1, 2, 3, 4, 5, 6]]
