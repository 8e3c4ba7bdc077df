"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: pollutant columns in payload order
POLLUTANTS = [
    "pm10",
    "pm2_5",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "dust",
    "uv_index",
]
# fixed values: names in the stored tables
TARGET = "us_aqi"
READINGS = [*POLLUTANTS, TARGET]
CALENDAR = ["hour", "day_of_week", "month"]
MEMORY = [
    "aqi_lag_24",
    "aqi_lag_48",
    "aqi_rolling_24_mean",
    "aqi_rolling_24_std",
    "aqi_change_rate",
]
FEATURES = [*POLLUTANTS, *CALENDAR, *MEMORY]
MODELS = ["random_forest", "ridge", "svr"]
PREDICTIONS = [f"{m}_pred" for m in MODELS]


def _struct(*groups: tuple[list[str], T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for names, t in groups for n in names])


RAW_HOURS = _struct(
    (["date"], T.TimestampType()), (READINGS, T.DoubleType()), (["city"], T.StringType())
)
FEATURE_HOURS = T.StructType(
    RAW_HOURS.fields
    + _struct((CALENDAR, T.IntegerType()), (MEMORY, T.DoubleType())).fields
)
FORECAST = _struct(
    (["date"], T.TimestampType()), (["city"], T.StringType()), (PREDICTIONS, T.DoubleType())
)
POOLED_FORECAST = _struct(
    (["time"], T.TimestampType()), (["predicted_us_aqi"], T.DoubleType()), (["city"], T.IntegerType())
)
CV_METRICS = _struct(
    (["city", "model"], T.StringType()), (["avg_rmse", "avg_mae", "avg_r2"], T.DoubleType())
)
TYPED_PAYLOAD = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("interval", T.LongType()),
    ]
    + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in READINGS]
)


def hourly_json(variables: list[str]) -> T.StructType:
    """Schema of a JSON payload whose ``hourly`` object holds one array per variable."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([T.StructField("hourly", T.StructType(arrays))])
