"""Station series derived from the star-schema tables the tests and queries run on.

Every value is an integer held as a double, so sums are exact whatever the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.schemas import READINGS

# fixed values: names, codes and coordinates of the stored cities
CITY_CODES = {"Karachi": 0, "Islamabad": 1, "Lahore": 2}
CITY_COORDINATES = {
    "Karachi": (24.8607, 67.0011),
    "Lahore": (31.5204, 74.3587),
    "Islamabad": (33.6844, 73.0479),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cents(column: str) -> Column:
    """Whole cents of a non-negative amount; ``round`` on doubles would go through decimals."""
    return F.floor(F.col(column) * 100 + 0.5)


def _mean_floor(value: Column, rows: Column | None = None) -> Column:
    """Floor of the mean of an integer column, over the rows where it is not null."""
    total = F.sum(value).cast("double")
    return F.floor(total / (rows if rows is not None else F.count(value))).cast("double")


def station_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Gappy hourly series of three cities with missing readings, from ``events``."""
    events = table(spark, folder, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date"),
        F.when(F.col("user_id") % 3 == 0, "Karachi")
        .when(F.col("user_id") % 3 == 1, "Lahore")
        .otherwise("Islamabad")
        .alias("city"),
        "event_type",
        _cents("value").alias("cents"),
    )

    def of_type(kind: str) -> Column:
        value = F.when(F.col("event_type") == kind, F.col("cents"))
        return F.floor(F.try_divide(F.sum(value).cast("double"), F.count(value))).cast("double")

    return (
        events.groupBy("city", "date")
        .agg(
            of_type("click").alias("pm10"),
            of_type("view").alias("pm2_5"),
            F.count("*").cast("double").alias("carbon_monoxide"),
            F.max("cents").cast("double").alias("nitrogen_dioxide"),
            F.min("cents").cast("double").alias("sulphur_dioxide"),
            of_type("purchase").alias("ozone"),
            of_type("signup").alias("dust"),
            of_type("error").alias("uv_index"),
            _mean_floor(F.col("cents")).alias("us_aqi"),
        )
        .select("date", *READINGS, "city")
    )


def _line_readings(lines: DataFrame) -> DataFrame:
    """Nine readings per (city, date) out of line items."""
    price = _mean_floor(_cents("l_extendedprice"))
    return (
        lines.groupBy("city", "date")
        .agg(
            _mean_floor(_cents("l_quantity")).alias("pm10"),
            _mean_floor(_cents("l_discount")).alias("pm2_5"),
            _mean_floor(_cents("l_tax")).alias("carbon_monoxide"),
            F.max("l_quantity").alias("nitrogen_dioxide"),
            F.count("*").cast("double").alias("sulphur_dioxide"),
            F.floor(100 * F.sum("l_linenumber") / F.count("*")).cast("double").alias("ozone"),
            F.floor(F.min("l_extendedprice")).cast("double").alias("dust"),
            F.floor(F.max("l_extendedprice")).cast("double").alias("uv_index"),
            F.floor(price / 500.0).cast("double").alias("us_aqi"),
        )
        .select("date", *READINGS, "city")
    )


def series_days(spark: SparkSession, folder: str) -> DataFrame:
    """Dense daily series of three cities without missing readings, from ``lineitem``."""
    lines = table(spark, folder, "lineitem")
    city = (
        F.when(F.col("l_returnflag") == "A", "Karachi")
        .when(F.col("l_returnflag") == "N", "Lahore")
        .otherwise("Islamabad")
    )
    return _line_readings(lines.withColumns({"city": city, "date": F.col("l_shipdate")}))


def shipment_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Irregular series growing with ``lineitem``: one hub with a large share of all rows.

    Items of one return flag all report to the hub, the others to one station per supplier;
    the second of the day comes from the order number.
    """
    lines = table(spark, folder, "lineitem")
    city = F.when(F.col("l_returnflag") == "N", "hub").otherwise(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    )
    second = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 86400
    date = F.timestamp_micros(
        F.unix_micros(F.col("l_shipdate").cast("timestamp")) + second * 1_000_000
    ).cast("timestamp_ntz")
    return _line_readings(lines.withColumns({"city": city, "date": date}))


def city_dimension(spark: SparkSession) -> DataFrame:
    rows = [(c, lat, lon) for c, (lat, lon) in CITY_COORDINATES.items()]
    return spark.createDataFrame(rows, "city string, latitude double, longitude double")


def city_codes(spark: SparkSession) -> DataFrame:
    rows = [(code, name) for name, code in CITY_CODES.items()]
    return spark.createDataFrame(rows, "city int, city_name string")


