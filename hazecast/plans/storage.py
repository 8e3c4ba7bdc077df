"""Queries that go through payloads, files and the streaming store and come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.models.evaluate import cv_average
from hazecast.operators.layout import lift, row_positions
from hazecast.operators.windows import station_features
from hazecast.plans.analysis import AVERAGES, METRIC_VIEWS, ROUNDED_AVERAGES, AVERAGE_DIGITS, fold_metrics_frame
from hazecast.plans.common import DAYS, HOURS, TICKS, rounded
from hazecast.plans.features import ALL, STD
from hazecast.plans.registry import query
from hazecast.plans.sql import FEATURES, not_null, rounded_std, with_series
from hazecast.schemas import FEATURE_HOURS, RAW_HOURS, READINGS, TARGET
from hazecast.session import new_folder, stored
from hazecast.sources import files, payloads
from hazecast.sources.tables import series_days, shipment_ticks, station_hours
from hazecast.streaming.append import FeatureStore, append_stream
from hazecast.streaming.event_time import follow

DAY_SECONDS = 86_400
ZONE = "Europe/Berlin"
SPRING, AUTUMN = 75, 290  # days after those of the event stream


def _yearly_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per city and year: at most 366 daily values per array."""
    days = series_days(spark, folder).withColumn("year", F.year("date"))
    ordered = F.array_sort(F.collect_list(F.struct("date", *READINGS)))
    packed = days.groupBy("city", "year").agg(ordered.alias("_rows"))
    start = F.unix_seconds(F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp"))
    return packed.select(
        "city",
        "year",
        start.alias("start"),
        (start + F.size("_rows") * DAY_SECONDS).alias("end"),
        F.lit(DAY_SECONDS).cast("long").alias("interval"),
        *[F.col(f"_rows.{c}").alias(c) for c in READINGS],
    )


# The payload carries no dates: row i of a year lands on its i-th day.
PAYLOAD_ROWS = with_series(
    f"SELECT make_timestamp(cast(year AS bigint), 1, 1, 0, 0, 0.0) + to_days(cast(i AS int)) AS date, "
    f"{', '.join(READINGS)}, city FROM (SELECT *, row_number() OVER (PARTITION BY city, year ORDER BY date) - 1 AS i "
    f"FROM (SELECT *, year(date) AS year FROM series_days))"
)


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(PAYLOAD_ROWS)
def typed_payload_rows(spark, folder):
    return _naive(payloads.typed_payload_rows(_yearly_payloads(spark, folder)))


@query(PAYLOAD_ROWS)
def json_payload_rows(spark, folder):
    packed = _yearly_payloads(spark, folder)
    axis = F.sequence("start", F.col("end") - F.col("interval"), "interval")
    times = F.transform(axis, lambda s: F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd'T'HH:mm"))
    hourly = F.struct(times.alias("time"), *READINGS)
    texts = packed.select("city", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
    return _naive(payloads.json_payload_rows(texts, READINGS))


def _last_sunday(month: int) -> str:
    """Instant at which clocks change: 01:00 UTC on the last Sunday of a month of 31 days."""
    last = f"make_date(cast(year(date) AS bigint), {month}, 31)"
    return f"({last} - cast(isodow({last}) % 7 AS int) + INTERVAL 1 HOUR)"


# Winter days are moved to where clocks change, in spring and in autumn.
MOVED_HOURS = f"""
SELECT date + CASE city WHEN 'Karachi' THEN INTERVAL {SPRING} DAY ELSE INTERVAL {AUTUMN} DAY END AS date,
       {', '.join(READINGS)}, city
FROM station_hours
"""
# The twin knows the true instants. A repeated local hour whose first pass is missing is read as the first.
LOCAL_HOURS = f"""
SELECT *, date + CASE WHEN date >= {_last_sunday(3)} AND date < {_last_sunday(10)} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END
         AS local_date,
       date >= {_last_sunday(10)} AND date < {_last_sunday(10)} + INTERVAL 1 HOUR AS second_pass
FROM moved_hours
"""
READ_HOURS = f"""
SELECT CASE WHEN second_pass AND count(*) OVER (PARTITION BY city, local_date) = 1 THEN date - INTERVAL 1 HOUR ELSE date END
         AS date, local_date, {', '.join(READINGS)}, city
FROM local_hours
"""


@query(
    with_series(
        f"SELECT local_date, {rounded_std()} FROM f",
        moved_hours=MOVED_HOURS,
        local_hours=LOCAL_HOURS,
        read_hours=READ_HOURS,
        f=f"SELECT *, {FEATURES.replace('(date)', '(local_date)')} FROM read_hours",
    )
)
def local_payload_features(spark, folder):
    """From payload files of a month each, in local time, to features: windows by instant, calendar by
    local time, the station from the path."""
    base = new_folder(spark, "payloads")
    local = F.from_utc_timestamp("date", ZONE)
    hours = station_hours(spark, folder)
    moved = F.when(F.col("city") == "Karachi", SPRING).otherwise(AUTUMN) * DAY_SECONDS
    hours = hours.withColumn("date", F.timestamp_seconds(F.unix_seconds(F.col("date").cast("timestamp")) + moved))
    hours = hours.withColumns({"time": F.date_format(local, payloads.HOUR), "month": F.date_format(local, "yyyy-MM")})
    ordered = F.array_sort(F.collect_list(F.struct("date", "time", *READINGS)))
    packed = hours.groupBy("city", "month").agg(ordered.alias("_rows"))
    hourly = F.struct(*[F.col(f"_rows.{c}").alias(c) for c in ("time", *READINGS)])
    texts = packed.select("city", "month", F.to_json(F.struct(hourly.alias("hourly"))).alias("value"))
    texts.write.partitionBy("city", "month").text(base)
    read = payloads.read_json_payloads(spark, f"{base}/*/*/", READINGS, city="city=([^/]+)/", zone=ZONE)
    featured = station_features(read.drop("source"), HOURS, nulls="keep", calendar="local_date")
    return rounded(_naive(featured), STD).select("local_date", *ALL)


@query(with_series(f"SELECT date, {', '.join(READINGS)}, city FROM shipment_ticks"))
def csv_round_trip(spark, folder):
    path = new_folder(spark, "csv")
    ticks = shipment_ticks(spark, folder)
    files.write_csv(ticks.withColumn("date", F.col("date").cast("timestamp")), path, TICKS, folders=False)
    return _naive(files.read_csv(spark, path, RAW_HOURS)).select("date", *READINGS, "city")


@query(with_series("SELECT date, us_aqi, city FROM series_days WHERE city = 'Lahore'"))
def parquet_station_pruned(spark, folder):
    path = new_folder(spark, "parquet")
    files.write_parquet(series_days(spark, folder), path, DAYS)
    return spark.read.parquet(path).where(F.col("city") == "Lahore").select("date", "us_aqi", "city")


@query(with_series(f"SELECT {ROUNDED_AVERAGES} FROM averages", **METRIC_VIEWS, averages=AVERAGES))
def metrics_json_round_trip(spark, folder):
    path = new_folder(spark, "metrics")
    files.write_metrics(cv_average(fold_metrics_frame(spark, folder)), path)
    return rounded(files.read_metrics(spark, path), AVERAGE_DIGITS).select("city", "model", *AVERAGE_DIGITS)


@query(
    with_series(
        f"SELECT {rounded_std()} FROM f WHERE {not_null(ALL)}",
        f=f"SELECT *, {FEATURES} FROM series_days",
    )
)
def streamed_append(spark, folder):
    """History stored first, then two overlapping drops of newer days through the stream."""
    base = new_folder(spark, "stream")
    placed = row_positions(series_days(spark, folder), DAYS)
    placed = placed.withColumn("date", F.col("date").cast("timestamp")).withColumn("back", F.col("_n") - F.col("_pos"))
    raw = lift(placed.drop("_n", "_pos")).select("date", *READINGS, "city", "back")
    drops = f"{base}/drops"
    store = FeatureStore(spark, f"{base}/store", DAYS)
    store.seed(raw.where("back > 300").drop("back"))
    for low, high in [(150, 300), (0, 160)]:
        raw.where(F.col("back").between(low + 1, high)).drop("back").write.mode("append").parquet(drops)
        stream = append_stream(store, drops, f"{base}/progress", once=True)
        stream.awaitTermination()
    return rounded(_naive(store.read()), STD).select(*ALL)


@query(
    with_series(
        f"SELECT {rounded_std()} FROM f WHERE {not_null(ALL)}",
        f=f"SELECT *, {FEATURES} FROM series_days",
    )
)
def streamed_new_stations(spark, folder):
    """Stations unknown to the store, whose first days come in drops too short for any feature, all
    others in two long ones."""
    base = new_folder(spark, "stream")
    placed = row_positions(series_days(spark, folder), DAYS)
    raw = lift(placed.withColumn("date", F.col("date").cast("timestamp"))).select("date", *READINGS, "city", "_pos")
    raw = stored(raw, "days")
    drops = f"{base}/drops"
    store = FeatureStore(spark, f"{base}/store", DAYS)
    begins = [0, 30, 60, 90, 120, 150, 600]
    for begin, end in zip(begins, [*begins[1:], None], strict=True):
        drop = raw.where(F.col("_pos") >= begin)
        drop = drop if end is None else drop.where(F.col("_pos") < end)
        drop.drop("_pos").write.mode("append").parquet(drops)
        append_stream(store, drops, f"{base}/progress", once=True).awaitTermination()
    return rounded(_naive(store.read()), STD).select(*ALL)


LATE_HOURS = 24
DROP_HOURS = 240


@query(
    with_series(
        f"SELECT {rounded_std()} FROM f WHERE date <= newest - INTERVAL {LATE_HOURS} HOUR",
        f=f"SELECT *, {FEATURES}, max(date) OVER (PARTITION BY city) AS newest FROM station_hours",
    )
)
def event_time_features(spark, folder):
    """Hours that arrive out of order, twice (the second time changed), and for one city days behind
    the others, through a stream that is started anew for every drop."""
    base = new_folder(spark, "stream")
    hours = station_hours(spark, folder).withColumn("date", F.col("date").cast("timestamp"))
    chance = F.pmod(F.xxhash64("date", "city"), F.lit(60))
    behind = F.when(F.col("city") == "Karachi", 130).otherwise(0)
    hours = stored(hours.select("date", *READINGS, "city", chance.alias("chance")), "hours")
    begin = hours.agg(F.min(F.unix_seconds("date"))).first()[0] or 0
    came = (F.unix_seconds("date") - begin) / 3600 + F.col("chance") % 12 + behind
    placed = hours.withColumn("drop", F.floor(came / DROP_HOURS))
    again = placed.where("chance < 12").withColumns({TARGET: F.col(TARGET) + 1000, "drop": F.col("drop") + 1})
    placed = stored(placed.unionByName(again), "placed", "drop")
    last = placed.agg(F.max("drop")).first()[0]
    for drop in range(0 if last is None else int(last) + 1):
        arrived = placed.where(F.col("drop") == drop).select("date", *READINGS, "city")
        arrived.write.mode("append").parquet(f"{base}/drops")
        follow(spark, f"{base}/drops", f"{base}/rows", f"{base}/progress", late_hours=LATE_HOURS, once=True).awaitTermination()
    return rounded(_naive(spark.read.schema(FEATURE_HOURS).parquet(f"{base}/rows")), STD).select(*ALL)
