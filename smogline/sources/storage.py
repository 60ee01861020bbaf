"""Table storage on plain parquet: range replace, key replace, range scans.

A table is a folder holding immutable *versions* plus an append-only log of
commits:

    <root>/_versions/     JSON rows {version, paths, schema}, appended per commit
    <root>/v-<time>-<id>/ parquet, optionally partitioned by calendar month

For a month-partitioned table a commit lists the month folders that make up
the version; unchanged months are carried over from earlier versions by
reference, so a range replace rewrites only the months it touches.  A table
replaced by key and date keeps a folder for every day of its newest month.

A write never reads and overwrites the same path: it builds the next version
from the current one (e.g. ``rows outside [s, e]  ∪  new rows``), writes it
to a fresh folder and only then appends its name to the log.  Readers take
the newest name in the log.  Nothing is ever deleted or overwritten, so a
failed job, a retried task or a lost executor leaves the previous version
current and never exposes a half-written table.

Writes also cut the lineage: later steps read the written version, not the
plan that produced it.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import config, schemas

POINTER = "_versions"
MONTH = "_month"  # partition column of date-partitioned tables (first day of the month)
DAYS = "_days"  # of tables replaced by key and date: a day (yyyy-mm-dd) of the newest month, or an earlier month (yyyy-mm)
LOG_SCHEMA = "version string, paths array<string>, schema string"
DATA_TYPES = {"weather": schemas.WEATHER, "airqual": schemas.AIRQUAL, "processed": schemas.processed(config.SELECTED_FEATURES)}


def _current(spark: SparkSession, root: str):
    """Newest commit-log entry (version, month folders or null, schema json)."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{root}/{POINTER}")
        return log.orderBy(F.col("version").desc()).first()  # one small row per commit
    except AnalysisException as e:
        if not _absent(e):
            raise
        return None


def _absent(e: AnalysisException) -> bool:
    """The path does not exist (any other failure must not pass for an empty table)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def _current_version(spark: SparkSession, root: str) -> str | None:
    cur = _current(spark, root)
    return None if cur is None else cur["version"]


def table_exists(spark: SparkSession, root: str) -> bool:
    return _current(spark, root) is not None


def _span_of(path: str) -> str:
    """The month (yyyy-mm) or day (yyyy-mm-dd) whose rows a folder holds."""
    column, _, value = path.rstrip("/").rsplit("/", 1)[1].partition("=")
    return value if column == DAYS else value[:7]


def _month_of(path: str) -> str:
    return f"{_span_of(path)[:7]}-01"


def _read_paths(spark: SparkSession, cur, months: tuple[str, str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(cur["schema"]))
    paths = list(cur["paths"])
    if months is not None:
        paths = [p for p in paths if months[0] <= _month_of(p) <= months[1]]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """Current version of the table; error if the table does not exist."""
    cur = _current(spark, root)
    if cur is None:
        raise FileNotFoundError(f"no table at {root}")
    if cur["paths"] is None:
        return spark.read.parquet(f"{root}/{cur['version']}")
    return _read_paths(spark, cur)


def _commit(spark: SparkSession, root: str, version: str, paths, schema: T.StructType) -> None:
    row = [(version, paths, schema.json())]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/{POINTER}")


def _write_months(df: DataFrame, root: str, v: str, days_from: str | None = None) -> list[str]:
    """Write ``df`` under ``root/v`` partitioned by month, or from the month ``days_from`` (yyyy-mm)
    on by day; return the folders."""
    by, span = MONTH, F.trunc("date", "MM")
    if days_from is not None:
        by, month = DAYS, F.date_format("date", "yyyy-MM")
        span = F.when(month < days_from, month).otherwise(F.date_format("date", "yyyy-MM-dd"))
    # rows of a folder meet first: its files follow its size, not the number of tasks
    df.withColumn(by, span).hint("rebalance", by).write.mode("errorifexists").partitionBy(by).parquet(f"{root}/{v}")
    files = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{v}").inputFiles()  # listing only, no job
    return sorted({f.rsplit("/", 1)[0] for f in files})


def _new_version() -> str:
    return f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # sortable by commit time


def write_table(df: DataFrame, root: str, partition_by: str | None = None, carried: list[str] | None = None) -> str:
    """Write ``df`` as a new version and append it to the commit log.

    ``partition_by="date"`` partitions by calendar month of ``date`` (daily
    folders would mean thousands of tiny files per year of history).  The
    log entry then lists the month folders that make up the version:
    the ones just written plus ``carried`` folders of earlier versions that
    did not change.  Range scans read only the folders of their months.
    """
    spark = df.sparkSession
    v = _new_version()
    if partition_by == "date":
        paths = list(carried or []) + _write_months(df, root, v)
        _commit(spark, root, v, paths, df.schema)
        return v
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{root}/{v}")
    _commit(spark, root, v, None, df.schema)
    return v


def _month_bounds(start, end) -> tuple[str, str]:
    s = dt.date.fromisoformat(str(start)[:10])
    e = dt.date.fromisoformat(str(end)[:10])
    return s.replace(day=1).isoformat(), e.replace(day=1).isoformat()


def scan_range(spark: SparkSession, root: str, start, end, order: bool = False) -> DataFrame:
    """Rows with ``start <= date <= end``; only the month folders of the range
    are read when the table is partitioned by date.  Ordered by date only
    when asked."""
    cur = _current(spark, root)
    if cur is None:
        raise FileNotFoundError(f"no table at {root}")
    if cur["paths"] is None:
        df = spark.read.parquet(f"{root}/{cur['version']}")
    else:
        df = _read_paths(spark, cur, _month_bounds(start, end))
    df = df.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return df.orderBy("date") if order else df


def exists_range(spark: SparkSession, root: str, start, end) -> bool:
    """True when the table holds at least one row in [start, end]; no table → False.

    ``limit(1)`` lets Spark stop at the first matching row.
    """
    if not table_exists(spark, root):
        return False
    return not scan_range(spark, root, start, end).limit(1).isEmpty()


def replaced_range(old: DataFrame | None, new: DataFrame, start, end) -> DataFrame:
    """The table after 'delete rows in [start, end], append new' (lazy)."""
    if old is None:
        return new
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    keep = old.filter(~F.coalesce(inside, F.lit(False)))  # a row without a date lies in no range
    return keep.unionByName(new.select(*old.columns))


def range_replace(spark: SparkSession, root: str, new: DataFrame, start, end, partition_by: str | None = "date") -> str:
    """Idempotent write: rows of [start, end] are replaced by ``new``.

    Dates inside the range that ``new`` lacks disappear (unlike a dynamic
    partition overwrite).  The first write creates the table.  For a
    month-partitioned table only the months overlapping the range are
    rewritten; every other month folder is carried into the new version
    unchanged, so a replace costs the size of the range, not of the table.
    """
    cur = _current(spark, root)
    if cur is None:
        return write_table(new, root, partition_by)
    if cur["paths"] is None or partition_by != "date":
        return write_table(replaced_range(read_table(spark, root), new, start, end), root, partition_by)
    lo, hi = _month_bounds(start, end)
    touched = [p for p in cur["paths"] if lo <= _month_of(p) <= hi]
    carried = [p for p in cur["paths"] if p not in touched]
    old = _read_paths(spark, dict(version=cur["version"], paths=touched, schema=cur["schema"]))
    return write_table(replaced_range(old, new, start, end), root, "date", carried=carried)


def replaced_keys(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus ``new`` (lazy)."""
    if old is None:
        return new
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def key_replace_months(spark: SparkSession, root: str, new: DataFrame, keys: list[str]) -> str:
    """Replace rows by a key that holds ``date``: only the months of ``new`` are
    read and rewritten, the others are carried over."""
    cur = _current(spark, root)
    if cur is None or cur["paths"] is None:
        old = None if cur is None else read_table(spark, root)
        return write_table(replaced_keys(old, new, keys), root, "date")
    months = {str(r[0]) for r in new.select(F.trunc("date", "MM")).distinct().collect()}  # at most the calendar's months
    touched = [p for p in cur["paths"] if _month_of(p) in months]
    old = _read_paths(spark, dict(version=cur["version"], paths=touched, schema=cur["schema"]))
    return write_table(replaced_keys(old, new, keys), root, "date", carried=[p for p in cur["paths"] if p not in touched])


def key_replace_days(spark: SparkSession, root: str, new: DataFrame, keys: list[str]) -> str:
    """Replace rows by a key that holds ``date``: only the days of ``new`` are read and rewritten.

    Every day of the table's newest month has a folder of its own, so a table that grows at its end
    costs each replace the days it touches, not the month so far.  The days of an earlier month are
    merged once, into one folder, by the first replace of a later month; late rows rewrite that
    folder.  Without a row in ``new`` the current version stays.
    """
    cur = _current(spark, root)
    found = [str(r[0]) for r in new.select(F.date_format("date", "yyyy-MM-dd")).distinct().collect()]  # at most the calendar's days
    if cur is not None and not found:
        return cur["version"]
    held = [] if cur is None else list(cur["paths"] or [])
    days = {d for d in found if d != "None"}
    newest = max({d[:7] for d in days} | {_month_of(p)[:7] for p in held if _span_of(p)[:1].isdigit()}, default="")
    if cur is not None and cur["paths"] is None:
        old, carried = read_table(spark, root), []
    else:
        spans = days | {d[:7] for d in days}
        touched = [p for p in held if _span_of(p) in spans or (len(_span_of(p)) == 10 and _span_of(p)[:7] < newest)]
        carried = [p for p in held if p not in touched]
        old = None if cur is None else _read_paths(spark, dict(version=cur["version"], paths=touched, schema=cur["schema"]))
    v = _new_version()
    paths = carried + _write_months(replaced_keys(old, new, keys), root, v, newest)
    _commit(spark, root, v, paths, new.schema if old is None else old.schema)
    return v


def key_replace(spark: SparkSession, root: str, new: DataFrame, keys: list[str]) -> tuple[str, int]:
    """Replace rows by key; returns (version, number of replaced rows)."""
    old = read_table(spark, root) if table_exists(spark, root) else None
    n_deleted = 0 if old is None else old.join(new.select(*keys), keys, "left_semi").count()
    return write_table(replaced_keys(old, new, keys), root), n_deleted


def log_batch(spark: SparkSession, root: str, batch_rows: DataFrame) -> str:
    return key_replace(spark, root, batch_rows, ["batch_start", "batch_end"])[0]


def upsert_model(spark: SparkSession, root: str, model_rows: DataFrame) -> tuple[str, int]:
    """Replace by model_version; the count lets callers warn when > 1 row went."""
    return key_replace(spark, root, model_rows, ["model_version"])


def prediction_bounds(preds: DataFrame):
    """(min, max) date of new predictions — one small aggregate."""
    r = preds.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    return r["lo"], r["hi"]


def log_predictions(spark: SparkSession, root: str, preds: DataFrame) -> str:
    """Delete all cities' rows between the new rows' min and max date, append."""
    lo, hi = prediction_bounds(preds)
    if lo is None:
        raise ValueError("no predictions to log: they hold no date")
    return range_replace(spark, root, preds, lo, hi)


# --- CSV round trip --------------------------------------------------------

def save_csv(df: DataFrame, root: str, data_type: str) -> str:
    if data_type not in DATA_TYPES:
        raise ValueError(f"data_type must be one of {sorted(DATA_TYPES)}, got {data_type!r}")
    path = f"{root}/{data_type}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_csv(spark: SparkSession, root: str, data_type: str, schema=None, start=None, end=None) -> DataFrame:
    """Read a CSV table back with its fixed schema; missing table is an error.

    ``schema`` names another one, as ``schemas.processed`` of other features does.  A file whose
    header names other columns is refused, and so is a value that its column's type cannot hold.
    """
    if data_type not in DATA_TYPES:
        raise ValueError(f"data_type must be one of {sorted(DATA_TYPES)}, got {data_type!r}")
    schema = schema or DATA_TYPES[data_type]
    reader = spark.read.option("header", True).option("enforceSchema", False).option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").schema(schema)
    try:
        df = reader.csv(f"{root}/{data_type}")
    except AnalysisException as e:
        if not _absent(e):
            raise
        raise FileNotFoundError(f"no {data_type} data under {root}") from e
    if start is not None and end is not None:
        df = df.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return df
