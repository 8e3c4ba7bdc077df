"""Column expressions and row-local frame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazecast.schemas import TARGET

# fixed values: upper bounds (exclusive) and names of the index levels
LEVELS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
TOP_LEVEL = "Hazardous"
HAZARD_INDEX = 100

# fixed values: short pollutant names
SHORT_NAMES = {
    "carbon_monoxide": "co",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
}

# fixed values: weights of the composite index
INDEX_WEIGHTS = {
    "pm2_5": 0.3,
    "pm10": 0.2,
    "nitrogen_dioxide": 0.15,
    "sulphur_dioxide": 0.15,
    "ozone": 0.1,
    "carbon_monoxide": 0.1,
}


def calendar_columns(time: str = "date") -> dict[str, Column]:
    """Hour, day of week (Monday is 0) and month of a timestamp column."""
    return {
        "hour": F.hour(time),
        "day_of_week": F.weekday(time),
        "month": F.month(time),
    }


def date_columns(time: str = "date") -> dict[str, Column]:
    """Day of month and year, which the older feature sets use."""
    return {"day": F.dayofmonth(time), "year": F.year(time)}


def aqi_level(index: str | Column, strict_reference: bool = False) -> Column:
    """Name of the index level. A missing index has no level, unless ``strict_reference``."""
    value = F.col(index) if isinstance(index, str) else index
    (lowest, first), *others = LEVELS
    level = F.when(value < lowest, F.lit(first))
    for bound, name in others:
        level = level.when(value < bound, F.lit(name))
    level = level.otherwise(F.lit(TOP_LEVEL))
    if strict_reference:
        return level
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), level)


def is_hazardous(prediction: str | Column, threshold: float = HAZARD_INDEX) -> Column:
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    return value > threshold


def row_mean(*columns: str) -> Column:
    """Mean over the columns of a row that are not null; null when all are."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(total, present)


def weighted_index(weights: dict[str, float] | None = None) -> Column:
    parts = [F.lit(w) * F.col(c) for c, w in (weights or INDEX_WEIGHTS).items()]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def relative_change(now: Column, before: Column) -> Column:
    """(now - before) / before; null where ``before`` is 0."""
    return F.try_divide(now - before, before)


def parsed_time(text: str | Column, fmt: str | None = None) -> Column:
    """Timestamp from text; text that is no timestamp gives null."""
    value = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing readings arrive as NaN from some sources; everything below expects NULL."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floating})


def rename_pollutants(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SHORT_NAMES)


def with_city(df: DataFrame, city: str) -> DataFrame:
    return df.withColumn("city", F.lit(city))


def numeric_features(df: DataFrame, target: str = TARGET) -> list[str]:
    """Names of all numeric columns but the target, in schema order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != target]


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows with no null in ``columns`` (all columns by default)."""
    return df.dropna(subset=columns)


def validated(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Fail at analysis time when a training table lacks its target or any numeric feature."""
    if target not in df.columns:
        raise ValueError(f"no target column {target!r} among {df.columns}")
    if not numeric_features(df, target):
        raise ValueError("no numeric feature column")
    return df
