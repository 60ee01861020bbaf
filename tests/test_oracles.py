"""Spark results equal their DuckDB oracles (sf0.001) for a representative
set of keys: scans, quality rules, windows, statistics, folds, monitoring."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.check_oracles import TABLES, rows_of  # noqa: E402

from .conftest import SF001

KEYS = [
    "preprocess_eval", "filter_sensors", "sensor_gap_stats_sparse", "monthly_coverage", "impute_gaps",
    "week_std", "acf", "pacf", "daily_rollup", "describe", "box_stats_month", "time_folds",
    "score_batches", "drift_check", "stations_in_radius", "missing_dates",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
