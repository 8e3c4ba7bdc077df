"""Queries on windows, fills, feature tables, forecast frames and appends."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazecast.functions.columns import calendar_columns, date_columns
from hazecast.operators import append, frames, windows
from hazecast.operators.layout import lift, row_positions
from hazecast.plans.common import DAYS, HOURS, TICKS, history_and_forecast, rounded, stored_ticks
from hazecast.plans.registry import query
from hazecast.plans.sql import FEATURES, FRAME, W, not_null, rounded_std, with_series
from hazecast.schemas import CALENDAR, MEMORY, POLLUTANTS, READINGS, TARGET
from hazecast.sources.tables import series_days, shipment_ticks, station_hours

ALL = ["date", *READINGS, "city", *CALENDAR, *MEMORY]
STD = {"aqi_rolling_24_std": 4}


def _features_sql(series: str) -> str:
    return with_series(
        f"SELECT {rounded_std()} FROM f WHERE {not_null(ALL)}",
        f=f"SELECT *, {FEATURES} FROM {series}",
    )


@query(_features_sql("station_hours"))
def station_feature_table(spark, folder):
    return rounded(windows.station_features(station_hours(spark, folder), HOURS), STD)


@query(_features_sql("series_days"))
def daily_feature_table(spark, folder):
    return rounded(windows.station_features(series_days(spark, folder), DAYS), STD)


@query(_features_sql("shipment_ticks"))
def tick_feature_table(spark, folder):
    return rounded(windows.station_features(stored_ticks(spark, folder), TICKS), STD)


FILLED = [*READINGS, *MEMORY]
CARRIED = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS {c}" for c in FILLED
)


@query(
    with_series(
        f"SELECT {rounded_std()} FROM g WHERE {not_null(ALL)}",
        f=f"SELECT *, {FEATURES} FROM station_hours",
        g=f"SELECT date, city, hour, day_of_week, month, {CARRIED} FROM f",
    )
)
def station_feature_table_filled(spark, folder):
    return rounded(windows.station_features(station_hours(spark, folder), HOURS, nulls="ffill_drop"), STD)


@query(
    with_series(
        f"SELECT date, city, us_aqi, lag(us_aqi, 24) OVER ({W}) AS aqi_lag_24, "
        f"lag(us_aqi, 48) OVER ({W}) AS aqi_lag_48 FROM shipment_ticks"
    )
)
def lag_rows(spark, folder):
    df = windows.with_lags(stored_ticks(spark, folder, TARGET), {"aqi_lag_24": 24, "aqi_lag_48": 48}, TICKS)
    return df.select("date", "city", TARGET, "aqi_lag_24", "aqi_lag_48")


@query(
    with_series(f"SELECT date, city, us_aqi, lead(us_aqi, 72) OVER ({W}) AS target_aqi FROM series_days")
)
def lead_target(spark, folder):
    df = windows.with_target_ahead(series_days(spark, folder), 72, DAYS)
    return df.select("date", "city", TARGET, "target_aqi")


@query(
    with_series(
        f"SELECT date, cast(hour(date) AS int) AS hour, cast(day(date) AS int) AS day, "
        f"cast(month(date) AS int) AS month, pm10, pm2_5, "
        f"coalesce(us_aqi - lag(us_aqi, 1) OVER ({W}), 0.0) AS aqi_change, us_aqi, "
        f"lead(us_aqi, 72) OVER ({W}) AS target_aqi, city FROM station_hours"
    )
)
def horizon_feature_table(spark, folder):
    return windows.horizon_features(station_hours(spark, folder), HOURS)


@query(
    with_series(
        f"SELECT date, city, pm10, coalesce(pm10 - lag(pm10, 1) OVER ({W}), 0.0) AS pm10_change FROM station_hours"
    )
)
def first_difference(spark, folder):
    df = windows.with_change(station_hours(spark, folder), HOURS, "pm10", "pm10_change")
    return df.select("date", "city", "pm10", "pm10_change")


@query(
    with_series(
        f"SELECT date, city, "
        f"CASE WHEN count(pm10) OVER ({W} {FRAME}) = 24 THEN avg(pm10) OVER ({W} {FRAME}) END AS pm10_24_mean, "
        f"round(CASE WHEN count(pm10) OVER ({W} {FRAME}) = 24 THEN stddev_samp(pm10) OVER ({W} {FRAME}) END, 4) "
        f"AS pm10_24_std FROM station_hours"
    )
)
def rolling_statistics(spark, folder):
    df = windows.with_rolling(station_hours(spark, folder), 24, HOURS, "pm10", "pm10")
    return rounded(df.select("date", "city", "pm10_24_mean", "pm10_24_std"), {"pm10_24_std": 4})


@query(
    with_series(
        f"SELECT date, city, (us_aqi - lag(us_aqi, 24) OVER ({W})) / nullif(lag(us_aqi, 24) OVER ({W}), 0) "
        f"AS aqi_change_rate FROM shipment_ticks"
    )
)
def relative_change_rows(spark, folder):
    made = {"aqi_change_rate": windows.memory_columns()["aqi_change_rate"]}
    df = windows.over_series(stored_ticks(spark, folder, TARGET), made, TICKS, back=24)
    return df.select("date", "city", "aqi_change_rate")


@query(
    with_series(
        "SELECT date, city, "
        + ", ".join(
            f"last_value({c} IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS {c}" for c in READINGS
        )
        + " FROM station_hours"
    )
)
def forward_filled(spark, folder):
    return windows.forward_fill(station_hours(spark, folder), READINGS, HOURS).select("date", "city", *READINGS)


@query(
    with_series(
        "SELECT date, city, "
        + ", ".join(
            f"first_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}"
            for c in READINGS
        )
        + " FROM station_hours"
    )
)
def backward_filled(spark, folder):
    return windows.backward_fill(station_hours(spark, folder), READINGS, HOURS).select("date", "city", *READINGS)


def _last_sql(series: str, n: int) -> str:
    return with_series(
        f"SELECT date, {', '.join(READINGS)}, city FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY city ORDER BY date DESC) AS back FROM {series}) WHERE back <= {n}"
    )


@query(_last_sql("shipment_ticks", 48))
def last_rows_per_station(spark, folder):
    return frames.last_rows(shipment_ticks(spark, folder), 48)


@query(_last_sql("station_hours", 1))
def latest_row(spark, folder):
    return frames.last_rows(station_hours(spark, folder), 1)


@query(
    with_series(
        "SELECT date, us_aqi, city FROM station_hours JOIN (SELECT city, max(date) AS newest "
        "FROM station_hours GROUP BY city) USING (city) WHERE date >= newest - INTERVAL 3 DAY"
    )
)
def trailing_days(spark, folder):
    return frames.trailing(station_hours(spark, folder), "3 days").select("date", TARGET, "city")


HISTORY = "SELECT date, us_aqi, city FROM placed WHERE back > 72 - {overlap}"
AHEAD = f"SELECT date, {', '.join(POLLUTANTS)}, city FROM placed WHERE back <= 72"


def _frame_sql(overlap: int) -> str:
    along = "PARTITION BY city ORDER BY segment, date"
    ordered = FEATURES.replace(W, along)
    filled = [TARGET, *POLLUTANTS, *MEMORY]
    fill = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({along} ROWS UNBOUNDED PRECEDING) AS {c}" for c in filled
    )
    back = ", ".join(
        f"first_value({c} IGNORE NULLS) OVER ({along} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}"
        for c in filled
    )
    nothing = ", ".join(f"cast(NULL AS double) AS {c}" for c in POLLUTANTS)
    return with_series(
        f"SELECT {rounded_std()} FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY segment DESC, "
        f"date DESC) AS back FROM b) WHERE back <= 72",
        placed="SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM series_days",
        history=HISTORY.format(overlap=overlap),
        tail="SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS r FROM history) "
        "WHERE r <= 48",
        ahead=AHEAD,
        mixed=f"SELECT 0 AS segment, date, us_aqi, {nothing}, city FROM tail UNION ALL "
        f"SELECT 1 AS segment, date, NULL AS us_aqi, {', '.join(POLLUTANTS)}, city FROM ahead",
        featured=f"SELECT *, {ordered} FROM mixed",
        f=f"SELECT segment, date, city, hour, day_of_week, month, {fill} FROM featured",
        b=f"SELECT segment, date, city, hour, day_of_week, month, {back} FROM f",
    )


@query(_frame_sql(0))
def forecast_frame(spark, folder):
    history, ahead = history_and_forecast(spark, folder)
    return rounded(frames.forecast_frame(history, ahead, DAYS), STD)


@query(_frame_sql(24))
def forecast_frame_overlapping(spark, folder):
    history, ahead = history_and_forecast(spark, folder, overlap=24)
    return rounded(frames.forecast_frame(history, ahead, DAYS), STD)


# Incoming rows: the newest 200 of every city, of which the first 100 are also stored already.
PLACED = "SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM series_days"
STORED_SQL = f"SELECT date, {', '.join(READINGS)}, city FROM placed WHERE back > 100"
FETCHED_SQL = f"SELECT date, {', '.join(READINGS)}, city FROM placed WHERE back <= 200"


def _stored_and_fetched(spark, folder):
    placed = row_positions(series_days(spark, folder), DAYS)
    back = F.col("_n") - F.col("_pos")
    stored, fetched = placed.where(back > 100), placed.where(back <= 200)
    return lift(stored.drop("_pos", "_n")), lift(fetched.drop("_pos", "_n"))


@query(
    with_series(
        f"SELECT segment, date, us_aqi, {', '.join(POLLUTANTS)}, city FROM (SELECT 0 AS segment, date, us_aqi, "
        + ", ".join(f"cast(NULL AS double) AS {c}" for c in POLLUTANTS)
        + f", city FROM history UNION ALL SELECT 1 AS segment, date, NULL AS us_aqi, {', '.join(POLLUTANTS)}, city FROM ahead)",
        placed=PLACED,
        history=HISTORY.format(overlap=0),
        ahead=AHEAD,
    )
)
def union_missing_columns(spark, folder):
    history, ahead = history_and_forecast(spark, folder)
    both = frames.segmented(history.select("date", TARGET, "city"), ahead)
    return both.select("segment", "date", TARGET, *POLLUTANTS, "city")


@query(
    with_series(
        "SELECT * FROM stored UNION ALL SELECT * FROM fetched", placed=PLACED, stored=STORED_SQL, fetched=FETCHED_SQL
    )
)
def union_all(spark, folder):
    stored, fetched = _stored_and_fetched(spark, folder)
    return stored.unionByName(fetched)


@query(
    with_series(
        f"SELECT date, {', '.join(READINGS)}, city FROM (SELECT *, row_number() OVER (PARTITION BY city, date "
        f"ORDER BY source) AS copy FROM (SELECT *, 0 AS source FROM stored UNION ALL "
        f"SELECT * REPLACE (us_aqi + 1 AS us_aqi), 1 AS source FROM fetched)) WHERE copy = 1",
        placed=PLACED,
        stored=STORED_SQL,
        fetched=FETCHED_SQL,
    )
)
def keep_first_per_hour(spark, folder):
    stored, fetched = _stored_and_fetched(spark, folder)
    corrected = fetched.withColumn(TARGET, F.col(TARGET) + 1)
    return append.merge_keep_existing(stored, corrected).select("date", *READINGS, "city")


@query(
    with_series(
        "SELECT * FROM stored UNION ALL SELECT fetched.* FROM fetched LEFT JOIN (SELECT city, max(date) AS newest "
        "FROM stored GROUP BY city) AS m ON fetched.city = m.city WHERE newest IS NULL OR date > newest",
        placed=PLACED,
        stored=STORED_SQL,
        fetched=FETCHED_SQL,
    )
)
def high_water_append(spark, folder):
    return append.appended(*_stored_and_fetched(spark, folder))


@query(
    with_series(
        f"SELECT {rounded_std()} FROM f WHERE {not_null(ALL)}",
        placed=PLACED,
        fetched=FETCHED_SQL,
        f=f"SELECT *, {FEATURES} FROM fetched",
    )
)
def chunk_feature_table(spark, folder):
    _, fetched = _stored_and_fetched(spark, folder)
    return rounded(append.chunk_features(fetched, DAYS), STD)


@query(
    with_series(
        f"SELECT {rounded_std()} FROM g WHERE back <= 200 AND {not_null(ALL)}",
        placed=PLACED,
        f=f"SELECT date, {', '.join(READINGS)}, city, back FROM placed WHERE back <= 248",
        g=f"SELECT *, {FEATURES} FROM f",
    )
)
def chunk_feature_table_with_history(spark, folder):
    stored, fetched = _stored_and_fetched(spark, folder)
    return rounded(append.chunk_features(fetched, DAYS, history=stored), STD)


@query(
    with_series(
        "SELECT date, city, cast(hour(date) AS int) AS hour, cast(isodow(date) - 1 AS int) AS day_of_week, "
        "cast(month(date) AS int) AS month, cast(day(date) AS int) AS day, cast(year(date) AS int) AS year "
        "FROM shipment_ticks"
    )
)
def calendar_parts(spark, folder):
    df = shipment_ticks(spark, folder).select("date", "city")
    return df.withColumns({**calendar_columns(), **date_columns()})
