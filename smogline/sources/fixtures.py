"""Adapters from the driver's star-schema tables to the engine's inputs.

* ``readings``        — sensor-day values: lineitem ⋈ supplier ⋈ nation ⋈ region;
                         city = region name, sensor = nation key, day = ship date.
* ``readings_sparse`` — same shape from orders ⋈ customer ⋈ nation ⋈ region
                         (long gaps: exercises both arms of the gap rule).
* ``weather``         — dense daily spine per city (region) over the lineitem date
                         span, measures derived from that day's lineitem averages.
* ``event_readings``  — intraday raw readings from ``events``
                         (city = event_type, sensor = user_id).

Join strategy is left to the planner: the dimension sides are tiny here and
are broadcast by Spark's size-checked automatic broadcast; at scale the
lineitem ⋈ supplier join is a sort-merge join on the supplier key, and AQE
splits skewed supplier partitions.  Nation (25 rows) and region (5 rows) are
fixed-size dimensions and are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .tables import table

# Fixed values of the weather adapter: defaults for days without lineitems.
WEATHER_DEFAULTS = {"q": 25.0, "di": 0.05, "tx": 0.04, "p": 40000.0}


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region → (nationkey, city); 25 rows by construction."""
    na = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    re = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return na.join(F.broadcast(re), na.n_regionkey == re.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("city")
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(city, sensor_id, date, pm25_avg), one row per sensor-day."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice")
    su = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    su_geo = su.join(F.broadcast(_geo(spark, sf_dir)), su.s_nationkey == F.col("n_nationkey")).select(
        "s_suppkey", "city", F.col("n_nationkey").cast("long").alias("sensor_id")
    )
    return (
        li.join(su_geo, li.l_suppkey == su_geo.s_suppkey)
        .groupBy("city", "sensor_id", F.to_date("l_shipdate").alias("date"))
        .agg((F.avg("l_extendedprice") / 1000 - 10).alias("pm25_avg"))
    )


def readings_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse variant: (city, sensor_id, date, pm25_avg) from orders."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    c_geo = c.join(F.broadcast(_geo(spark, sf_dir)), c.c_nationkey == F.col("n_nationkey")).select(
        "c_custkey", "city", F.col("n_nationkey").cast("long").alias("sensor_id")
    )
    return (
        o.join(c_geo, o.o_custkey == c_geo.c_custkey)
        .groupBy("city", "sensor_id", F.to_date("o_orderdate").alias("date"))
        .agg((F.avg("o_totalprice") / 1000).alias("pm25_avg"))
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense (city, date) weather table with the 11 raw weather columns."""
    li = table(
        spark, sf_dir, "lineitem", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    ).withColumn("date", F.to_date("l_shipdate"))
    # per-day global averages: one row per calendar day (bounded by the calendar)
    day = li.groupBy("date").agg(
        F.avg("l_quantity").alias("q"),
        F.avg("l_discount").alias("di"),
        F.avg("l_tax").alias("tx"),
        F.avg("l_extendedprice").alias("p"),
    )
    # one scalar subquery for both ends of the span
    span = day.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    spine = table(spark, sf_dir, "region", "r_regionkey", "r_name").select(
        F.col("r_regionkey").cast("double").alias("rk"),
        F.col("r_name").alias("city"),
        F.explode(F.sequence(lo, hi)).alias("date"),
    )
    d = WEATHER_DEFAULTS
    j = spine.join(day, "date", "left")
    q = F.coalesce(F.col("q"), F.lit(d["q"]))
    di = F.coalesce(F.col("di"), F.lit(d["di"]))
    tx = F.coalesce(F.col("tx"), F.lit(d["tx"]))
    p = F.coalesce(F.col("p"), F.lit(d["p"]))
    tmax = 0.6 * q + F.col("rk")
    return j.select(
        "date",
        (tmax - 100 * di).alias("temp_min"),
        tmax.alias("temp_max"),
        (tmax - 50 * di).alias("temp_avg"),
        (1000 * tx).alias("cloud_cover"),
        (40 + q).alias("humidity"),
        (20 * di).alias("precipitation"),
        (1000 + q).alias("pressure"),
        (100 * tx).alias("wind_speed"),
        (p % 360).alias("wind_direction"),
        "city",
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday raw readings: (city, sensor_id, ts, value, ts_local)."""
    ev = table(spark, sf_dir, "events", "ts", "user_id", "event_type", "value", "event_id")
    return ev.select(
        F.col("event_type").alias("city"),
        F.col("user_id").alias("sensor_id"),
        "event_id",
        "ts",
        "value",
        local_stamp(F.col("ts")).alias("ts_local"),
    )


# Fixed value of the adapter: local time is UTC+02:00.
LOCAL_OFFSET_HOURS = 2


def local_stamp(ts) -> F.Column:
    """ISO local timestamp string with a +02:00 suffix, as sensors report it."""
    shifted = ts + F.expr(f"INTERVAL {LOCAL_OFFSET_HOURS} HOURS")
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f"+0{LOCAL_OFFSET_HOURS}:00"))


def city_table(spark: SparkSession) -> DataFrame:
    """The configured cities with coordinates (a fixed handful of rows)."""
    rows = [(i, name, lat, lon) for i, (name, lat, lon) in enumerate(config.CITIES)]
    return spark.createDataFrame(rows, "idx int, city string, lat double, lon double")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations derived from suppliers.

    id = supplier key; monitor-grade when the account balance is positive;
    active from its first to its last lineitem ship date; placed within
    about ±0.1° of a configured city (chosen by nation key); two sensors,
    PM2.5 (parameter 2) and PM10 (parameter 1).
    """
    su = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate")
    span = li.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    cities = city_table(spark)
    cities_n = len(config.CITIES)
    j = su.join(span, su.s_suppkey == span.l_suppkey).join(
        F.broadcast(cities), F.pmod(su.s_nationkey, F.lit(cities_n)) == F.col("idx")
    )
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    jitter_lat = (F.pmod(F.col("s_suppkey") * 7919, F.lit(2001)) - 1000) / 10000.0
    jitter_lon = (F.pmod(F.col("s_suppkey") * 104729, F.lit(2001)) - 1000) / 10000.0
    sensor = lambda off, par: F.struct(
        (F.col("s_suppkey") * 10 + off).alias("id"), F.struct(F.lit(par).alias("id")).alias("parameter")
    )
    return j.select(
        "city",
        F.col("s_suppkey").alias("id"),
        (F.col("s_acctbal") > 0).alias("isMonitor"),
        F.date_format("first", fmt).alias("first_utc"),
        F.date_format("last", fmt).alias("last_utc"),
        (F.col("lat") + jitter_lat).alias("latitude"),
        (F.col("lon") + jitter_lon).alias("longitude"),
        F.array(sensor(1, 2), sensor(2, 1)).alias("sensors"),
    )
