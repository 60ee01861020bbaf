"""Incremental daily rollup with Structured Streaming.

Raw readings arrive as files; each micro-batch updates the per
(city, sensor, local day) aggregates held in the state store, and
``foreachBatch`` upserts the updated rows by key into a versioned table
(``sources.storage``), rewriting only the days they touch.  Replaying a micro-batch after a failure rewrites
the same keys, so the sink is idempotent; the checkpoint folder (under the
shared checkpoint directory) makes the query restartable after executor or
driver loss.

State per sensor-day: sums, least and greatest value, a bit for every local
hour, and how often each value occurred, which gives the exact quantiles.
Equal values are combined before the shuffle, so state and traffic follow a
day's distinct values.  A day's state goes when the watermark passes its end;
from then on its row is final and equal to the batch ``daily_rollup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import storage

KEYS = ["city", "sensor_id", "date"]
RAW_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("sensor_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts_local", T.StringType()),
    ]
)


def rollup_stream(raw: DataFrame, offset_hours: int = 2, watermark: str = "2 days") -> DataFrame:
    """Streaming aggregate per (city, sensor, local day).

    Local days of a fixed UTC offset are tumbling windows shifted by
    ``24 - offset`` hours; the watermark bounds the state kept for late rows.
    Columns as in the batch ``daily_rollup``.
    """
    local_hour = F.hour(F.col("ts") + F.expr(f"INTERVAL {offset_hours} HOURS"))
    shift = f"{(24 - offset_hours) % 24} hours"
    w = F.window("ts", "1 day", "1 day", shift)
    agg = raw.withWatermark("ts", watermark).groupBy(w.alias("w"), "city", "sensor_id").agg(
        F.avg("value").alias("pm25_avg"),
        F.min("value").alias("pm25_min"),
        F.max("value").alias("pm25_max"),
        F.percentile("value", [0.25, 0.5, 0.75]).alias("q"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), local_hour)).alias("hours"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    return agg.select(
        "city",
        "sensor_id",
        F.to_date(F.col("w.start") + F.expr(f"INTERVAL {offset_hours} HOURS")).alias("date"),
        "pm25_avg",
        "pm25_min",
        F.col("q")[0].alias("pm25_q25"),
        F.col("q")[1].alias("pm25_median"),
        F.col("q")[2].alias("pm25_q75"),
        "pm25_max",
        (F.bit_count("hours") * 100.0 / 24).alias("coverage"),
        "n_readings",
    )


def stream_daily_rollup(
    spark: SparkSession, source_dir: str, out_root: str, checkpoint: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Run the incremental rollup over every file available now; returns
    the resulting table (lazy read).  Calling it again with the same
    checkpoint processes only files that arrived since (state and offsets
    live in the checkpoint)."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.parquet(source_dir)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()  # read twice by the key replace
        try:
            storage.key_replace_days(batch.sparkSession, out_root, batch, KEYS)
        finally:
            batch.unpersist()

    q = (
        rollup_stream(raw)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return storage.read_table(spark, out_root)


def write_arrivals(raw: DataFrame, root: str, slices: int = 8, on_arrival=None) -> list[str]:
    """Write ``raw`` as ``slices`` time-ordered slices, oldest first, calling
    ``on_arrival(path)`` after each one — e.g. to run the stream over what has
    arrived so far, as a scheduler would.  Slice bounds come from one
    aggregate.  ``raw`` is dealt into the slices by one pass, beside them
    (``_dealt``); an arrival copies its slice from there."""
    spark = raw.sparkSession
    b = raw.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    step = (hi - lo) / slices
    at = sum((F.col("ts") >= F.lit(lo + step * i)).cast("int") for i in range(1, slices)) if slices > 1 else F.lit(0)
    dealt = raw.filter(F.col("ts").isNotNull()).withColumn("_slice", at)
    dealt.write.partitionBy("_slice").parquet(f"{root}/_dealt")
    dealt = spark.read.schema(dealt.schema).parquet(f"{root}/_dealt")
    paths = []
    for i in range(slices):
        path = f"{root}/slice={i:03d}"
        dealt.filter(F.col("_slice") == i).drop("_slice").write.parquet(path)
        paths.append(path)
        if on_arrival is not None:
            on_arrival(path)
    return paths
