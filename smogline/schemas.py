"""Fixed schemas of the engine's tables and raw payloads (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, DT, B, I, TS = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.DateType(),
    T.BooleanType(),
    T.IntegerType(),
    T.TimestampNTZType(),  # wall-clock run times, no zone (as the source records them)
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AIRQUAL = _struct(
    ("sensor_id", L),
    ("date_from_utc", S),
    ("date_from_local", S),
    ("date_to_utc", S),
    ("date_to_local", S),
    ("pm25_avg", D),
    ("pm25_min", D),
    ("pm25_q25", D),
    ("pm25_median", D),
    ("pm25_q75", D),
    ("pm25_max", D),
    ("coverage", D),
    ("city", S),
    ("date", DT),
)

READINGS = _struct(("city", S), ("sensor_id", L), ("date", DT), ("pm25_avg", D))

WEATHER = _struct(
    ("date", DT),
    ("temp_min", D),
    ("temp_max", D),
    ("temp_avg", D),
    ("cloud_cover", D),
    ("humidity", D),
    ("precipitation", D),
    ("pressure", D),
    ("wind_speed", D),
    ("wind_direction", D),
    ("city", S),
)



def processed(features) -> T.StructType:
    """Processed rows: the features in order, then date and target; all numbers but the city."""
    return _struct(*[(f, S if f == "city" else D) for f in features], ("date", DT), ("target", D))


BATCHES = _struct(
    ("batch_start", DT),
    ("batch_end", DT),
    ("champion_version", S),
    ("champion_rmse", D),
    ("drift_detected", B),
    ("challenger_version", S),
    ("rmse_challenger", D),
    ("run_date", TS),
    ("promotion_applied", B),
)

MODELS = _struct(
    ("model_version", S),
    ("train_start", DT),
    ("train_end", DT),
    ("eval_start", DT),
    ("eval_end", DT),
    ("reference_rmse", D),
    ("alias", S),
)

EVENTS = _struct(
    ("at", T.TimestampType()),
    ("step", I),
    ("kind", S),
    ("model_version", S),
    ("score", D),
    ("train_start", DT),
    ("train_end", DT),
    ("eval_start", DT),
    ("eval_end", DT),
    ("batch_start", DT),
    ("batch_end", DT),
)

PREDICTIONS = _struct(("date", DT), ("city", S), ("y_true", D), ("y_pred", D), ("model_version", S))

# --- raw JSON payloads -----------------------------------------------------

_TS_PAIR = _struct(("utc", S), ("local", S))

SENSOR_PAYLOAD = _struct(
    ("meta", _struct(("found", L))),
    (
        "results",
        T.ArrayType(
            _struct(
                ("period", _struct(("datetimeFrom", _TS_PAIR), ("datetimeTo", _TS_PAIR))),
                ("value", D),
                (
                    "summary",
                    _struct(("min", D), ("q25", D), ("median", D), ("q75", D), ("max", D)),
                ),
                ("coverage", _struct(("percentComplete", D))),
            )
        ),
    ),
)

STATION_PAYLOAD = _struct(
    (
        "results",
        T.ArrayType(
            _struct(
                ("id", L),
                ("isMonitor", B),
                ("datetimeFirst", _struct(("utc", S))),
                ("datetimeLast", _struct(("utc", S))),
                ("coordinates", _struct(("latitude", D), ("longitude", D))),
                (
                    "sensors",
                    T.ArrayType(_struct(("id", L), ("parameter", _struct(("id", I))))),
                ),
            )
        ),
    ),
)

WEATHER_PAYLOAD = _struct(
    ("date", S),
    ("temperature", _struct(("min", D), ("max", D))),
    ("cloud_cover", _struct(("afternoon", D))),
    ("humidity", _struct(("afternoon", D))),
    ("precipitation", _struct(("total", D))),
    ("pressure", _struct(("afternoon", D))),
    ("wind", _struct(("max", _struct(("speed", D), ("direction", D))))),
    ("_corrupt_record", S),
)
