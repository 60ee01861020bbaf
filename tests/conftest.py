import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from smogline.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("*", shuffle_partitions=8)
    yield s


def series_df(spark, values, city="A", start="2024-01-01", col="pm25_avg"):
    """One daily series from a list (None = missing)."""
    import datetime as dt

    d0 = dt.date.fromisoformat(start)
    rows = [(city, d0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"city string, date date, {col} double")
