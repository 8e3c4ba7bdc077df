"""Queries on projections, lookups, filters and summary statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazecast.functions import columns as fn
from hazecast.models.evaluate import best_model, cv_average, regression_metrics
from hazecast.models.folds import with_blocks
from hazecast.operators import stats
from hazecast.operators.layout import lift
from hazecast.operators.lookup import lookup
from hazecast.plans.common import (
    DAYS,
    DAY_VIEWS,
    PREDICTION_VIEWS,
    complete_days,
    predicted_days,
    rounded,
    stored_ticks,
)
from hazecast.plans.registry import query
from hazecast.plans.sql import not_null, with_series
from hazecast.schemas import POLLUTANTS, PREDICTIONS, READINGS, TARGET
from hazecast.session import stored
from hazecast.sources.tables import (
    CITY_CODES,
    CITY_COORDINATES,
    city_codes,
    city_dimension,
    series_days,
    shipment_ticks,
    station_hours,
    table,
)

LEVEL_SQL = " ".join(f"WHEN {{x}} < {bound} THEN '{name}'" for bound, name in fn.LEVELS)
LEVEL_SQL = "CASE WHEN {x} IS NULL THEN NULL " + LEVEL_SQL + f" ELSE '{fn.TOP_LEVEL}' END"


@query(with_series("SELECT date, pm10, pm2_5, ozone FROM shipment_ticks"))
def project_by_name(spark, folder):
    return shipment_ticks(spark, folder).select("date", "pm10", "pm2_5", "ozone")


@query(with_series(f"SELECT {', '.join(POLLUTANTS)} FROM shipment_ticks"))
def project_numeric_features(spark, folder):
    df = fn.validated(shipment_ticks(spark, folder))
    return df.select(*fn.numeric_features(df))


@query(
    with_series(
        "SELECT date, city, carbon_monoxide AS co, nitrogen_dioxide AS no2, sulphur_dioxide AS so2, ozone AS o3 "
        "FROM station_hours"
    )
)
def renamed_pollutants(spark, folder):
    return fn.rename_pollutants(station_hours(spark, folder)).select("date", "city", *fn.SHORT_NAMES.values())


@query("SELECT event_id, value, 'Karachi' AS city FROM events")
def constant_city(spark, folder):
    return fn.with_city(table(spark, folder, "events").select("event_id", "value"), "Karachi")


@query(with_series(f"SELECT * FROM station_hours WHERE {not_null(READINGS)}"))
def complete_rows(spark, folder):
    return fn.drop_incomplete(station_hours(spark, folder))


@query(with_series(f"SELECT date, city, pm10, us_aqi FROM station_hours WHERE {not_null(['pm10', 'us_aqi'])}"))
def aligned_target(spark, folder):
    df = station_hours(spark, folder).select("date", "city", "pm10", TARGET)
    return fn.drop_incomplete(df, ["pm10", TARGET])


@query(with_series("SELECT * FROM shipment_ticks WHERE city = 'hub'"))
def one_city(spark, folder):
    return shipment_ticks(spark, folder).where(F.col("city") == "hub")


@query(
    with_series(
        f"SELECT date, city, pm10 / 50.0 AS index, {LEVEL_SQL.format(x='pm10 / 50.0')} AS level FROM station_hours"
    )
)
def aqi_levels(spark, folder):
    index = F.col("pm10") / 50.0
    return station_hours(spark, folder).select("date", "city", index.alias("index"), fn.aqi_level(index).alias("level"))


@query(
    with_series(
        "SELECT date, city, random_forest_pred / 100.0 AS index FROM predicted WHERE random_forest_pred / 100.0 > 100",
        **PREDICTION_VIEWS,
    )
)
def hazard_alerts(spark, folder):
    index = F.col("random_forest_pred") / 100.0
    df = predicted_days(spark, folder).select("date", "city", index.alias("index"))
    return df.where(fn.is_hazardous("index"))


@query(
    with_series("SELECT date, city, round(ridge_pred, 2) AS ridge_pred FROM predicted", **PREDICTION_VIEWS)
)
def rounded_predictions(spark, folder):
    return rounded(predicted_days(spark, folder).select("date", "city", "ridge_pred"), {"ridge_pred": 2})


CODE_NAMES = "CASE l_linenumber % 4 " + " ".join(
    f"WHEN {code} THEN '{name}'" for name, code in CITY_CODES.items()
)


@query(f"SELECT l_orderkey, l_linenumber, {CODE_NAMES} END AS city_name FROM lineitem")
def city_code_lookup(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    coded = lines.withColumn("city", F.col("l_linenumber") % 4)
    named = lookup(coded, city_codes(spark), ["city"], spread=["l_orderkey"], stored=True)
    return named.select("l_orderkey", "l_linenumber", "city_name")


def _coordinate_sql(i: int) -> str:
    return "CASE city " + " ".join(f"WHEN '{c}' THEN {at[i]}" for c, at in CITY_COORDINATES.items()) + " END"


@query(
    with_series(
        f"SELECT date, city, cast({_coordinate_sql(0)} AS double) AS latitude, "
        f"cast({_coordinate_sql(1)} AS double) AS longitude FROM station_hours"
    )
)
def city_coordinates(spark, folder):
    hours = station_hours(spark, folder).select("date", "city")
    return lookup(hours, city_dimension(spark), ["city"], spread=["date"], stored=True)


@query(
    with_series(
        "SELECT date, city, CASE WHEN pm10 IS NULL AND pm2_5 IS NULL THEN NULL ELSE "
        "(coalesce(pm10, 0.0) + coalesce(pm2_5, 0.0)) / "
        "(CASE WHEN pm10 IS NULL THEN 0 ELSE 1 END + CASE WHEN pm2_5 IS NULL THEN 0 ELSE 1 END) END "
        "AS aqi_estimate FROM station_hours"
    )
)
def pollutant_row_mean(spark, folder):
    estimate = fn.row_mean("pm10", "pm2_5").alias("aqi_estimate")
    return station_hours(spark, folder).select("date", "city", estimate)


@query(
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS at FROM events"
)
def parsed_times(spark, folder):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    at = fn.parsed_time(text).cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", at.alias("at"))


@query(
    with_series(
        "SELECT date, city, round(0.3 * pm2_5 + 0.2 * pm10 + 0.15 * nitrogen_dioxide + 0.15 * sulphur_dioxide "
        "+ 0.1 * ozone + 0.1 * carbon_monoxide, 3) AS index FROM series_days"
    )
)
def weighted_index(spark, folder):
    return series_days(spark, folder).select("date", "city", F.round(fn.weighted_index(), 3).alias("index"))


def _unpivot_sql(columns: list[str], source: str, name: str, value: str, ids: str = "city, date") -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{c}' AS {name}, cast({c} AS double) AS {value} FROM {source}" for c in columns
    )


def _describe_sql(columns: list[str], source: str, **views: str) -> str:
    return with_series(
        'SELECT city, "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, '
        'min(v) AS min, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, '
        'max(v) AS max FROM long GROUP BY city, "column"',
        **views,
        long=_unpivot_sql(columns, source, '"column"', "v"),
    )


MOMENTS = {"mean": 4, "std": 4}


@query(_describe_sql(READINGS, "station_hours"))
def describe_readings(spark, folder):
    return rounded(stats.describe(stored(station_hours(spark, folder), "hours"), READINGS), MOMENTS)


@query(_describe_sql(READINGS, "shipment_ticks"))
def describe_ticks(spark, folder):
    return rounded(stats.describe(stored_ticks(spark, folder), READINGS), MOMENTS)


QUARTILES = dict.fromkeys(["q25", "q50", "q75"], 4)


@query(
    _describe_sql(PREDICTIONS, "predicted", **PREDICTION_VIEWS)
    .replace("quantile_cont(v, 0.25)", "round(quantile_cont(v, 0.25), 4)")
    .replace("quantile_cont(v, 0.5)", "round(quantile_cont(v, 0.5), 4)")
    .replace("quantile_cont(v, 0.75)", "round(quantile_cont(v, 0.75), 4)")
)
def describe_predictions(spark, folder):
    return rounded(stats.describe(stored(predicted_days(spark, folder), "predicted"), PREDICTIONS), MOMENTS | QUARTILES)


def _histogram_sql(column: str, source: str, **views: str) -> str:
    return with_series(
        "SELECT g.city, g.bin, lo + (g.bin - 1) * width AS bin_start, coalesce(n, 0) AS rows FROM "
        "(SELECT city, lo, width, cast(unnest(range(1, 41)) AS int) AS bin FROM spans) AS g LEFT JOIN "
        "(SELECT city, bin, count(*) AS n FROM placed GROUP BY city, bin) AS c "
        "ON g.city = c.city AND g.bin = c.bin",
        **views,
        spans=f"SELECT city, min({column}) AS lo, (max({column}) - min({column})) / 40 AS width FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY city",
        placed=f"SELECT s.city, CASE WHEN width = 0 THEN 1 ELSE least(40, cast(floor(({column} - lo) / width) AS int) + 1) "
        f"END AS bin FROM {source} AS s JOIN spans ON s.city = spans.city WHERE {column} IS NOT NULL",
    )


@query(_histogram_sql(TARGET, "shipment_ticks"))
def index_histogram(spark, folder):
    return stats.histogram(stored_ticks(spark, folder, TARGET), TARGET)


@query(
    _histogram_sql(
        "pred",
        "long",
        **PREDICTION_VIEWS,
        long=" UNION ALL ".join(f"SELECT '{c} ' || city AS city, {c} AS pred FROM predicted" for c in PREDICTIONS),
    )
)
def prediction_histogram(spark, folder):
    """Every model of every city is a series of its own."""
    long = stats.long_form(predicted_days(spark, folder), PREDICTIONS, ["city", "date"])
    return stats.histogram(long.withColumn("city", F.concat_ws(" ", "model", "city")), "pred")


@query(
    with_series(
        "SELECT b.city, q25, q50, q75, min(CASE WHEN inside THEN us_aqi END) AS whisker_low, "
        "max(CASE WHEN inside THEN us_aqi END) AS whisker_high, "
        "count(CASE WHEN NOT inside THEN 1 END) AS outliers FROM "
        "(SELECT t.city, us_aqi, q25, q50, q75, us_aqi BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) "
        "AS inside FROM shipment_ticks AS t JOIN box ON t.city = box.city) AS b GROUP BY b.city, q25, q50, q75",
        box="SELECT city, quantile_cont(us_aqi, 0.25) AS q25, quantile_cont(us_aqi, 0.5) AS q50, "
        "quantile_cont(us_aqi, 0.75) AS q75 FROM shipment_ticks GROUP BY city",
    )
)
def index_box(spark, folder):
    return stats.box_summary(stored_ticks(spark, folder, TARGET), TARGET)


def _correlation_sql(columns: list[str], source: str, **views: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT city, '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 4) AS r FROM {source} GROUP BY city"
        for x in columns
        for y in columns
    )
    defined = f"SELECT city, x, y, CASE WHEN NOT isnan(r) THEN r END AS r FROM ({cells})"
    return with_series(defined, **views)


@query(_correlation_sql(READINGS, "station_hours"))
def reading_correlations(spark, folder):
    return rounded(stats.correlations(station_hours(spark, folder), READINGS), {"r": 4})


@query(_correlation_sql(PREDICTIONS, "predicted", **PREDICTION_VIEWS))
def prediction_correlations(spark, folder):
    return rounded(stats.correlations(predicted_days(spark, folder), PREDICTIONS), {"r": 4})


@query(
    with_series(
        " UNION ALL ".join(
            f"SELECT city, '{c}' AS feature, round(regr_slope(us_aqi, {c}), 4) AS slope, "
            f"round(regr_intercept(us_aqi, {c}), 4) AS intercept, round(regr_r2(us_aqi, {c}), 4) AS r2 "
            f"FROM station_hours GROUP BY city"
            for c in POLLUTANTS
        )
    )
)
def trend_lines(spark, folder):
    lines = stats.trend_lines(station_hours(spark, folder), POLLUTANTS)
    return rounded(lines, {"slope": 4, "intercept": 4, "r2": 4})


@query(
    with_series(
        "SELECT date, s.city, ozone, us_aqi, round(intercept + slope * ozone, 4) AS fitted FROM series_days AS s JOIN "
        "(SELECT city, regr_slope(us_aqi, ozone) AS slope, regr_intercept(us_aqi, ozone) AS intercept "
        "FROM series_days GROUP BY city) AS l ON s.city = l.city"
    )
)
def trend_fitted_points(spark, folder):
    return rounded(stats.trend_fitted(series_days(spark, folder), "ozone", TARGET, DAYS), {"fitted": 4})


@query(
    with_series(
        f"SELECT city, date, model, pred FROM ({_unpivot_sql(PREDICTIONS, 'predicted', 'model', 'pred')})",
        **PREDICTION_VIEWS,
    )
)
def trend_series(spark, folder):
    return stats.long_form(predicted_days(spark, folder), PREDICTIONS, ["city", "date"])


@query(
    with_series(
        "SELECT city, model, round(avg(pred), 4) AS mean_pred FROM "
        f"({_unpivot_sql(PREDICTIONS, 'predicted', 'model', 'pred')}) GROUP BY city, model",
        **PREDICTION_VIEWS,
    )
)
def model_means(spark, folder):
    return rounded(stats.model_means(predicted_days(spark, folder)), {"mean_pred": 4})


@query(
    with_series(
        f"SELECT date, city, index, {LEVEL_SQL.format(x='index')} AS level FROM (SELECT date, city, "
        "random_forest_pred / 100.0 AS index, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back "
        "FROM predicted) WHERE back = 1",
        **PREDICTION_VIEWS,
    )
)
def latest_cards(spark, folder):
    return stats.latest_cards(predicted_days(spark, folder), "random_forest_pred", DAYS, scale=100.0)


@query(with_series("SELECT DISTINCT city FROM shipment_ticks"))
def distinct_cities(spark, folder):
    return stats.distinct_cities(shipment_ticks(spark, folder))


@query(with_series("SELECT date, city, us_aqi FROM shipment_ticks ORDER BY city, date"))
def sorted_by_date(spark, folder):
    return stats.sorted_by_date(shipment_ticks(spark, folder).select("date", "city", TARGET))


@query(with_series("SELECT date, city, us_aqi FROM shipment_ticks ORDER BY date, city LIMIT 5"))
def head_preview(spark, folder):
    return stats.preview(shipment_ticks(spark, folder).select("date", "city", TARGET))


BLOCK_SQL = """
SELECT *, CASE WHEN n // 6 = 0 OR pos < n - 5 * (n // 6) THEN 0
               ELSE cast((pos - (n - 5 * (n // 6))) // (n // 6) AS int) + 1 END AS block
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date) - 1 AS pos,
             count(*) OVER (PARTITION BY city) AS n FROM {source})
"""
SCORED_SQL = "SELECT b.city, date, block AS fold, model, pred, us_aqi FROM blocked AS b JOIN long USING (city, date) WHERE block > 0"
METRICS_SQL = """
SELECT city, model, fold, count(*) AS rows, sqrt(sum((us_aqi - pred) * (us_aqi - pred)) / count(*)) AS rmse,
       avg(abs(us_aqi - pred)) AS mae,
       1 - sum((us_aqi - pred) * (us_aqi - pred)) / (var_pop(us_aqi) * count(*)) AS r2
FROM scored GROUP BY city, model, fold
"""
METRIC_VIEWS = {
    **PREDICTION_VIEWS,
    "blocked": BLOCK_SQL.format(source="predicted"),
    "long": _unpivot_sql(PREDICTIONS, "predicted", "model", "pred"),
    "scored": SCORED_SQL,
    "metrics": METRICS_SQL,
}


def fold_metrics_frame(spark, folder):
    """Metrics of the persistence forecasts, per city, model and fold."""
    blocked = lift(with_blocks(predicted_days(spark, folder), DAYS)).where(F.col("block") > 0)
    long = stats.long_form(blocked, PREDICTIONS, ["city", "date", TARGET, "block"])
    return regression_metrics(long.withColumnRenamed("block", "fold"), ["city", "model", "fold"])


@query(
    with_series(
        "SELECT city, model, fold, rows, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2 FROM metrics",
        **METRIC_VIEWS,
    )
)
def fold_metrics(spark, folder):
    return rounded(fold_metrics_frame(spark, folder), {"rmse": 4, "mae": 4, "r2": 4})


AVERAGES = "SELECT city, model, avg(rmse) AS avg_rmse, avg(mae) AS avg_mae, avg(r2) AS avg_r2 FROM metrics GROUP BY city, model"
AVERAGE_DIGITS = {"avg_rmse": 4, "avg_mae": 4, "avg_r2": 4}
ROUNDED_AVERAGES = "city, model, " + ", ".join(f"round({c}, 4) AS {c}" for c in AVERAGE_DIGITS)


@query(with_series(f"SELECT {ROUNDED_AVERAGES} FROM averages", **METRIC_VIEWS, averages=AVERAGES))
def cv_averages(spark, folder):
    return rounded(cv_average(fold_metrics_frame(spark, folder)), AVERAGE_DIGITS)


@query(
    with_series(
        f"SELECT {ROUNDED_AVERAGES} FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_r2 DESC, "
        "CASE model WHEN 'random_forest_pred' THEN 1 WHEN 'ridge_pred' THEN 2 ELSE 3 END) AS place FROM averages) "
        "WHERE place = 1",
        **METRIC_VIEWS,
        averages=AVERAGES,
    )
)
def best_models(spark, folder):
    chosen = best_model(cv_average(fold_metrics_frame(spark, folder)), order=PREDICTIONS)
    return rounded(chosen, AVERAGE_DIGITS)


@query(
    with_series(
        "SELECT date, city, block FROM blocked",
        **DAY_VIEWS,
        blocked=BLOCK_SQL.format(source="complete"),
    )
)
def fold_blocks(spark, folder):
    return with_blocks(complete_days(spark, folder).select("date", "city"), DAYS)


