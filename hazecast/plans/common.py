"""Derived frames several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.operators.layout import DAY, Series, lift, row_positions
from hazecast.operators.windows import station_features
from hazecast.plans.sql import FEATURES as FEATURES_SQL
from hazecast.plans.sql import not_null
from hazecast.schemas import FEATURES, POLLUTANTS, TARGET
from hazecast.session import stored
from hazecast.sources.tables import series_days, shipment_ticks

HOURS = Series(slot_seconds=7 * DAY)  # a week of hours per slot
DAYS = Series(slot_seconds=365 * DAY)
TICKS = Series(slot_seconds=None, rows_per_slot=50_000)
LARGE_SLOTS = Series(slot_seconds=None, rows_per_slot=200_000)
HORIZON = 72

FEATURED_DAYS = f"SELECT *, {FEATURES_SQL} FROM series_days"
COMPLETE_DAYS = f"SELECT * FROM featured WHERE {not_null(FEATURES)}"
PREDICTED_DAYS = """
SELECT date, city, us_aqi, aqi_lag_24 AS random_forest_pred, aqi_rolling_24_mean AS ridge_pred,
       aqi_lag_48 AS svr_pred
FROM complete
"""
DAY_VIEWS = {"featured": FEATURED_DAYS, "complete": COMPLETE_DAYS}
PREDICTION_VIEWS = {**DAY_VIEWS, "predicted": PREDICTED_DAYS}


def complete_days(spark: SparkSession, folder: str) -> DataFrame:
    return station_features(series_days(spark, folder), DAYS)


def stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """The same table computed once, for fits that read it several times."""
    return stored(complete_days(spark, folder), "days")


def stored_ticks(spark: SparkSession, folder: str, *readings: str) -> DataFrame:
    """The tick series, or some of its readings, computed once for queries that read it again."""
    ticks = shipment_ticks(spark, folder)
    return stored(ticks.select("date", "city", *readings) if readings else ticks, "ticks")


def predicted_days(spark: SparkSession, folder: str) -> DataFrame:
    """Persistence forecasts standing in for the three models."""
    return complete_days(spark, folder).select(
        "date",
        "city",
        TARGET,
        F.col("aqi_lag_24").alias("random_forest_pred"),
        F.col("aqi_rolling_24_mean").alias("ridge_pred"),
        F.col("aqi_lag_48").alias("svr_pred"),
    )


def history_and_forecast(spark: SparkSession, folder: str, overlap: int = 0) -> tuple[DataFrame, DataFrame]:
    """Last 72 days of every city as forecast input, the days before (and ``overlap``) as history."""
    placed = row_positions(series_days(spark, folder), DAYS)
    begins = F.col("_n") - HORIZON
    history = placed.where(F.col("_pos") < begins + overlap)
    forecast = placed.where(F.col("_pos") >= begins)
    return (
        lift(history.drop("_pos", "_n")),
        lift(forecast.drop("_pos", "_n")).select("date", *POLLUTANTS, "city"),
    )


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})
