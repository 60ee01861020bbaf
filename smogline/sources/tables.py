"""Reading the driver's parquet tables with column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Base-table DataFrames per (application, path): reading parquet resolves the
# file list and footers eagerly, so building a plan repeatedly over the same
# immutable inputs would otherwise pay that on every call.
_BASE: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan of ``{sf_dir}/{name}.parquet`` projected to ``columns``.

    Selecting immediately keeps the scan's ReadSchema to what is used.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)  # an id() may come back after a restart
    df = _BASE.get(key)
    if df is None:
        df = _BASE[key] = spark.read.parquet(path)
    return df.select(*columns) if columns else df
