import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 593
    assert len({r.city for r in rows}) == 3
    assert df.columns[-2:] == ["date", "target"]


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    for k in o:
        assert "SELECT" in o[k].upper()


def test_preprocess_invariant_to_partitioning(spark):
    from smogline.plans import preprocess as pp
    from smogline.sources import fixtures

    d = "/root/testdata/sf0.001"
    r, w = fixtures.readings(spark, d), fixtures.weather(spark, d)
    import pytest

    key = lambda row: (row.city, row.date)
    a = sorted(pp.preprocess_eval(r, w).collect(), key=key)
    b = sorted(pp.preprocess_eval(r.repartition(7).orderBy("pm25_avg"), w.repartition(3)).collect(), key=key)
    assert len(a) == len(b) == 593
    for x, y in zip(a, b):
        for f in x.__fields__:
            vx, vy = x[f], y[f]
            if isinstance(vx, float):
                assert vx == pytest.approx(vy, rel=1e-12, abs=1e-12)  # summation order only
            else:
                assert vx == vy


def test_scale_conf_sizes_partitions():
    from smogline.session import scale_conf

    c = scale_conf(100 * 1024**4, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    small = scale_conf(10 * 1024**2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
