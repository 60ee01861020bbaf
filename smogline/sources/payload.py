"""Raw JSON payloads: sensor measurements, station searches, daily weather.

Readers use one globbed ``spark.read.json`` with an explicit schema (no
inference pass) and flatten with ``explode`` and dotted selects; the keys
carried by the folder layout (``city=…/sensor_id=…``) come back through
Spark's partition discovery.  Writers produce the same layout from tables
Spark derived from the driver data, so the readers are exercised on data
that grows with the inputs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config, schemas
from .. import functions as fx

# Earth radius (m) for great-circle distances.
EARTH_RADIUS_M = 6371000.0


# --- sensor measurement payloads ----------------------------------------------

PACK_BYTES = 128 << 20


def _sensor_payloads(daily: DataFrame) -> DataFrame:
    """One payload per (city, sensor): ``{meta: {found}, results: [...]}``.

    ``daily`` has the daily-rollup columns plus local/UTC period strings.
    A payload holds one sensor's days (one row per day — bounded by the
    calendar).
    """
    result = F.struct(
        F.struct(
            F.struct(F.col("date_from_utc").alias("utc"), F.col("date_from_local").alias("local")).alias("datetimeFrom"),
            F.struct(F.col("date_to_utc").alias("utc"), F.col("date_to_local").alias("local")).alias("datetimeTo"),
        ).alias("period"),
        F.col("pm25_avg").alias("value"),
        F.struct(
            F.col("pm25_min").alias("min"), F.col("pm25_q25").alias("q25"), F.col("pm25_median").alias("median"),
            F.col("pm25_q75").alias("q75"), F.col("pm25_max").alias("max"),
        ).alias("summary"),
        F.struct(F.col("coverage").alias("percentComplete")).alias("coverage"),
    )
    return daily.groupBy("city", "sensor_id").agg(
        F.struct(F.count(F.lit(1)).alias("found")).alias("meta"),
        F.sort_array(F.collect_list(F.struct(F.col("date_from_utc").alias("_k"), result.alias("r")))).alias("_rs"),
    ).select("city", "sensor_id", "meta", F.col("_rs.r").alias("results"))


def write_sensor_payloads(daily: DataFrame, root: str) -> str:
    """A file per payload under ``city=…/sensor_id=…``, as a fetch of single sensors leaves them."""
    _sensor_payloads(daily).write.mode("overwrite").partitionBy("city", "sensor_id").json(root)
    return root


def pack_sensor_payloads(daily: DataFrame, root: str, file_bytes: int = PACK_BYTES) -> str:
    """Payloads as JSON lines in files of about ``file_bytes``, in order of sensors, and a manifest.

    ``<root>/data`` holds the lines, each with its city and sensor; ``<root>/manifest`` a row per
    file: its name, bytes, payloads and least and greatest sensor.  The number of files follows the
    bytes, not the sensors; a scan of some sensors reads only the files whose range holds one.
    """
    lines = _sensor_payloads(daily).select("sensor_id", "city", F.to_json(F.struct("city", "sensor_id", "meta", "results")).alias("value")).checkpoint()
    total = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    ordered = lines.repartitionByRange(files, "sensor_id", "city").sortWithinPartitions("sensor_id", "city")
    ordered.select("value").write.mode("overwrite").text(f"{root}/data")
    _packed(lines.sparkSession, f"{root}/data").groupBy("file").agg(
        F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("payloads"), F.min("sensor_id").alias("first"), F.max("sensor_id").alias("last"),
    ).write.mode("overwrite").parquet(f"{root}/manifest")
    return root


def _packed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("city", T.StringType()), T.StructField("sensor_id", T.LongType()), *schemas.SENSOR_PAYLOAD.fields])
    raw = spark.read.schema(schema).json(path)
    return raw.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))


def scan_packed_payload(spark: SparkSession, root: str, sensors: list[int] | None = None) -> DataFrame:
    """``scan_airqual_payload`` of packed payloads; with ``sensors``, of theirs alone, read
    from the files that the manifest names for them."""
    if sensors is None:
        return _flat_payload(_packed(spark, f"{root}/data"))
    wanted = F.exists(F.array(*[F.lit(int(s)) for s in sensors]), lambda s: s.between(F.col("first"), F.col("last"))) if sensors else F.lit(False)
    names = [r["file"] for r in spark.read.parquet(f"{root}/manifest").where(wanted).select("file").collect()]  # the files to read
    raw = _packed(spark, [f"{root}/data/{n}" for n in names]) if names else _packed(spark, f"{root}/data").where("false")
    return _flat_payload(raw.where(F.col("sensor_id").isin(*[int(s) for s in sensors])))


def period_strings(date: Column, offset_hours: int = 2) -> list[Column]:
    """Local midnight-to-midnight period of a day in a fixed UTC offset."""
    start_local = F.to_timestamp(date)
    start_utc = start_local - F.expr(f"INTERVAL {offset_hours} HOURS")
    fmt_l = "yyyy-MM-dd'T'HH:mm:ss"
    suffix = F.lit(f"+0{offset_hours}:00")
    return [
        F.concat(F.date_format(start_utc, fmt_l), F.lit("Z")).alias("date_from_utc"),
        F.concat(F.date_format(start_local, fmt_l), suffix).alias("date_from_local"),
        F.concat(F.date_format(start_utc + F.expr("INTERVAL 1 DAY"), fmt_l), F.lit("Z")).alias("date_to_utc"),
        F.concat(F.date_format(start_local + F.expr("INTERVAL 1 DAY"), fmt_l), suffix).alias("date_to_local"),
    ]


def scan_airqual_payload(spark: SparkSession, root: str) -> DataFrame:
    """Flatten every sensor payload under ``root`` to the 14 airqual columns.

    Sensors with empty ``results`` contribute no row.  ``date`` is the first
    ten characters of the local period start.
    """
    return _flat_payload(spark.read.schema(schemas.SENSOR_PAYLOAD).option("basePath", root).json(root))


def _flat_payload(raw: DataFrame) -> DataFrame:
    r = raw.select("city", F.col("sensor_id").cast("long").alias("sensor_id"), F.explode("results").alias("r"))
    return r.select(
        "sensor_id",
        F.col("r.period.datetimeFrom.utc").alias("date_from_utc"),
        F.col("r.period.datetimeFrom.local").alias("date_from_local"),
        F.col("r.period.datetimeTo.utc").alias("date_to_utc"),
        F.col("r.period.datetimeTo.local").alias("date_to_local"),
        F.col("r.value").alias("pm25_avg"),
        F.col("r.summary.min").alias("pm25_min"),
        F.col("r.summary.q25").alias("pm25_q25"),
        F.col("r.summary.median").alias("pm25_median"),
        F.col("r.summary.q75").alias("pm25_q75"),
        F.col("r.summary.max").alias("pm25_max"),
        F.col("r.coverage.percentComplete").alias("coverage"),
        "city",
        fx.local_date(F.col("r.period.datetimeFrom.local")).alias("date"),
    )


# --- station search payloads ----------------------------------------------------

def write_station_payloads(stations: DataFrame, root: str, page_size: int = 1000) -> str:
    """Station search results per city, paged: ``{results: [station, ...]}``.

    ``stations``: city, id, isMonitor, first_utc, last_utc, latitude,
    longitude, sensors (array<struct<id, parameter: struct<id>>>).  A city's
    stations are spread over ceil(n / page_size) pages by a hash of the
    station id, so no payload row grows with the number of stations.
    """
    st = F.struct(
        "id",
        "isMonitor",
        F.struct(F.col("first_utc").alias("utc")).alias("datetimeFirst"),
        F.struct(F.col("last_utc").alias("utc")).alias("datetimeLast"),
        F.struct("latitude", "longitude").alias("coordinates"),
        "sensors",
    )
    pages = stations.groupBy("city").agg(F.ceil(F.count(F.lit(1)) / page_size).cast("long").alias("_np"))
    paged = stations.join(pages, "city").withColumn("page", F.pmod(F.xxhash64("id"), F.col("_np")))
    out = paged.groupBy("city", "page").agg(F.sort_array(F.collect_list(st)).alias("results"))
    out.write.mode("overwrite").partitionBy("city").json(root)
    return root


def filter_stations(spark: SparkSession, root: str, start, end, parameter_id: int = config.PM25_PARAMETER_ID) -> DataFrame:
    """Sensor ids of monitor-grade stations active over the whole project.

    Keep stations with ``isMonitor``, first reading on/before ``start`` and
    last reading on/after ``end`` (UTC instants), then their sensors that
    measure ``parameter_id``.
    """
    raw = spark.read.schema(schemas.STATION_PAYLOAD).option("basePath", root).json(root)
    st = raw.select("city", F.explode("results").alias("s"))  # every page of every city
    first = F.to_timestamp(F.col("s.datetimeFirst.utc"))
    last = F.to_timestamp(F.col("s.datetimeLast.utc"))
    kept = st.filter(
        F.col("s.isMonitor")
        & (last >= F.to_timestamp(F.lit(str(end))))
        & (first <= F.to_timestamp(F.lit(str(start))))
    )
    sensors = kept.select("city", F.col("s.id").alias("station_id"), F.explode("s.sensors").alias("x"))
    return sensors.filter(F.col("x.parameter.id") == parameter_id).select(
        "city", "station_id", F.col("x.id").alias("sensor_id")
    )


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = p2 - p1
    dl = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(a))


def stations_in_radius(cities: DataFrame, stations: DataFrame, radius_m: float = config.STATION_RADIUS_M) -> DataFrame:
    """(city, station_id, distance_m) for stations within ``radius_m`` of a city.

    A grid equi-join instead of a cross product: stations fall in cells of
    ``radius`` degrees of latitude; each city probes the cells its circle can
    touch (3 latitude rows × enough longitude columns for its latitude), so
    the join is a hash join on the cell and only nearby pairs are compared.
    """
    cell = radius_m / (EARTH_RADIUS_M * math.pi / 180.0)  # degrees of latitude per radius
    st = stations.select(
        "station_id", F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"),
        F.floor(F.col("latitude") / cell).alias("cy"), F.floor(F.col("longitude") / cell).alias("cx"),
    )
    span = F.ceil(F.lit(1.0) / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("lat")) + cell, F.lit(89.9)))), F.lit(1e-6)))
    probes = cities.select(
        "city", "lat", "lon",
        F.explode(F.sequence(F.floor(F.col("lat") / cell) - 1, F.floor(F.col("lat") / cell) + 1)).alias("cy"),
        F.floor(F.col("lon") / cell).alias("_cx0"),
        span.cast("long").alias("_k"),
    ).select(
        "city", "lat", "lon", "cy",
        F.explode(F.sequence(F.col("_cx0") - F.col("_k"), F.col("_cx0") + F.col("_k"))).alias("cx"),
    )
    pairs = probes.join(st, ["cy", "cx"])
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    return pairs.select("city", "station_id", d.alias("distance_m")).filter(F.col("distance_m") <= radius_m)


# --- weather payloads -------------------------------------------------------------

def write_weather_payloads(weather: DataFrame, root: str) -> str:
    """One payload per (city, day) under ``city=…``."""
    out = weather.select(
        "city",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.struct(F.col("temp_min").alias("min"), F.col("temp_max").alias("max")).alias("temperature"),
        F.struct(F.col("cloud_cover").alias("afternoon")).alias("cloud_cover"),
        F.struct(F.col("humidity").alias("afternoon")).alias("humidity"),
        F.struct(F.col("precipitation").alias("total")).alias("precipitation"),
        F.struct(F.col("pressure").alias("afternoon")).alias("pressure"),
        F.struct(F.struct(F.col("wind_speed").alias("speed"), F.col("wind_direction").alias("direction")).alias("max")).alias("wind"),
    )
    out.write.mode("overwrite").partitionBy("city").json(root)
    return root


WEATHER_REQUIRED = ["date", "temperature", "cloud_cover", "humidity", "precipitation", "pressure", "wind"]


def _read_weather_raw(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.schema(schemas.WEATHER_PAYLOAD)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("basePath", root)
        .json(root)
    )


def _bad_weather(raw: DataFrame) -> Column:
    missing = F.lit(False)
    for k in WEATHER_REQUIRED:
        missing = missing | F.col(k).isNull()
    return F.col("_corrupt_record").isNotNull() | missing


def quarantine_bad_weather(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(good payload rows, quarantined rows): unparsable or key-missing
    payloads are reported (with their file) and never flattened."""
    raw = _read_weather_raw(spark, root).withColumn("_file", F.col("_metadata.file_path"))
    bad = _bad_weather(raw)
    return raw.filter(~bad), raw.filter(bad).select("city", "_file", "_corrupt_record")


def scan_weather_payload(spark: SparkSession, root: str) -> DataFrame:
    """Flatten good weather payloads to the 11 weather columns."""
    good, _ = quarantine_bad_weather(spark, root)
    return good.select(
        F.to_date("date", "yyyy-MM-dd").alias("date"),
        F.col("temperature.min").alias("temp_min"),
        F.col("temperature.max").alias("temp_max"),
        ((F.col("temperature.min") + F.col("temperature.max")) / 2).alias("temp_avg"),
        F.col("cloud_cover.afternoon").alias("cloud_cover"),
        F.col("humidity.afternoon").alias("humidity"),
        F.col("precipitation.total").alias("precipitation"),
        F.col("pressure.afternoon").alias("pressure"),
        F.col("wind.max.speed").alias("wind_speed"),
        F.col("wind.max.direction").alias("wind_direction"),
        "city",
    )


def merge_weather_files(spark: SparkSession, root: str, start, end) -> DataFrame:
    """All cities' daily files in one globbed read, restricted to [start, end]."""
    return scan_weather_payload(spark, root).filter(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
