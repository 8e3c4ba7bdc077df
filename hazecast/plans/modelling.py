"""Queries on splits, scaling, fitting, scoring and attribution."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hazecast.functions.columns import is_hazardous, row_mean
from hazecast.models import attribution, forest, kernel, linear, score, selection
from hazecast.models.evaluate import cv_average
from hazecast.models.folds import SPLITS, with_blocks, with_holdout, with_random_split
from hazecast.operators import frames
from hazecast.operators.windows import horizon_features
from hazecast.plans.analysis import BLOCK_SQL
from hazecast.plans.common import (
    DAYS,
    DAY_VIEWS,
    LARGE_SLOTS,
    TICKS,
    complete_days,
    history_and_forecast,
    rounded,
    stored_days,
    stored_ticks,
)
from hazecast.plans.registry import query
from hazecast.plans.sql import with_series
from hazecast.schemas import FEATURES, PREDICTIONS, TARGET
from hazecast.session import new_folder, settle, stored
from hazecast.sources import files
from hazecast.sources.tables import series_days

PAIR = ["pm10", "aqi_lag_24"]
HOLDOUT_SQL = """
SELECT *, row_number() OVER (PARTITION BY city ORDER BY date)
       > count(*) OVER (PARTITION BY city) - ceil(0.2 * count(*) OVER (PARTITION BY city)) AS is_test
FROM complete
"""


@query(with_series("SELECT date, city, is_test FROM split", **DAY_VIEWS, split=HOLDOUT_SQL))
def chronological_holdout(spark, folder):
    return with_holdout(complete_days(spark, folder).select("date", "city"), 0.2, DAYS)


@query(
    with_series(
        "SELECT date, city, ('0x' || substr(md5('42|' || city || '|' || epoch_us(date)), 1, 8))::BIGINT % 1000000 < 200000 AS is_test "
        "FROM series_days"
    )
)
def random_split(spark, folder):
    return with_random_split(series_days(spark, folder).select("date", "city"), 0.2, 42, DAYS)


@query(
    with_series(
        "SELECT date, s.city, is_test, round((pm10 - m1) / d1, 4) AS pm10, "
        "round((aqi_lag_24 - m2) / d2, 4) AS aqi_lag_24 FROM split AS s JOIN "
        "(SELECT city, avg(pm10) AS m1, stddev_pop(pm10) AS d1, avg(aqi_lag_24) AS m2, "
        "stddev_pop(aqi_lag_24) AS d2 FROM split WHERE NOT is_test GROUP BY city) AS t ON s.city = t.city",
        **DAY_VIEWS,
        split=HOLDOUT_SQL,
    )
)
def standard_scaler(spark, folder):
    split = with_holdout(complete_days(spark, folder).select("date", "city", *PAIR), 0.2, DAYS)
    stats = linear.scaler_stats(split.where(~F.col("is_test")), PAIR, ["city"])
    scaled = linear.standardized(split, stats, PAIR, ["city"], spread=["date"])
    return rounded(scaled.select("date", "city", "is_test", *PAIR), dict.fromkeys(PAIR, 4))


# Ridge on two standardised features in closed form; fold 0 is the fit on all rows.
RIDGE_VIEWS = {
    **DAY_VIEWS,
    "blocked": BLOCK_SQL.format(source="complete"),
    "moments": """
SELECT city, fold, count(*) AS n, avg(us_aqi) AS y, avg(pm10) AS m1, avg(aqi_lag_24) AS m2,
       stddev_pop(pm10) AS s1, stddev_pop(aqi_lag_24) AS s2, corr(pm10, aqi_lag_24) AS r,
       covar_pop(pm10, us_aqi) AS c1, covar_pop(aqi_lag_24, us_aqi) AS c2
FROM blocked JOIN (SELECT unnest(range(0, 6)) AS fold) ON fold = 0 OR block < fold
GROUP BY city, fold
""",
    "ridge": """
SELECT city, fold, n, y, m1, m2, s1, s2,
       ((n + 1) * (n * c1 / s1) - n * r * (n * c2 / s2)) / ((n + 1) * (n + 1) - n * r * n * r) AS w1,
       ((n + 1) * (n * c2 / s2) - n * r * (n * c1 / s1)) / ((n + 1) * (n + 1) - n * r * n * r) AS w2
FROM moments
""",
}


def _scored_by_refit(spark, folder):
    """Complete rows and the refitted two-feature model of every city."""
    features = stored_days(spark, folder)
    models = settle(linear.fit_ridge(features, PAIR, TARGET, DAYS))
    return features, models.where(F.col("fold") == linear.REFIT)


@query(
    with_series(
        " UNION ALL ".join(
            f"SELECT city, cast(fold AS int) AS fold, '{c}' AS feature, round(w{i}, 4) AS coef, round(m{i}, 4) AS mean, "
            f"round(s{i}, 4) AS scale, round(y, 4) AS intercept FROM ridge"
            for i, c in enumerate(PAIR, 1)
        ),
        **RIDGE_VIEWS,
    )
)
def ridge_two_features(spark, folder):
    fit = linear.coefficient_rows(linear.fit_ridge(complete_days(spark, folder), PAIR, TARGET, DAYS), DAYS)
    return rounded(fit, {"coef": 4, "mean": 4, "scale": 4, "intercept": 4})


@query(
    with_series(
        "SELECT date, c.city, round(y + w1 * (pm10 - m1) / s1 + w2 * (aqi_lag_24 - m2) / s2, 4) AS ridge_pred "
        "FROM complete AS c JOIN ridge ON c.city = ridge.city WHERE fold = 0",
        **RIDGE_VIEWS,
    )
)
def linear_score_join(spark, folder):
    features, refit = _scored_by_refit(spark, folder)
    scored = linear.score_linear(features, refit, PAIR, DAYS)
    return rounded(scored.select("date", "city", "ridge_pred"), {"ridge_pred": 4})


@query(
    with_series(
        "SELECT s.city, fold, count(*) AS rows, 'ridge' AS model, round(sqrt(avg(e * e)), 4) AS rmse, "
        "round(avg(abs(e)), 4) AS mae, round(1 - sum(e * e) / (var_pop(us_aqi) * count(*)), 4) AS r2 FROM "
        "(SELECT b.city, fold, us_aqi, us_aqi - (y + w1 * (pm10 - m1) / s1 + w2 * (aqi_lag_24 - m2) / s2) AS e "
        "FROM blocked AS b JOIN ridge ON b.city = ridge.city AND b.block = fold WHERE fold > 0) AS s "
        "GROUP BY s.city, fold",
        **RIDGE_VIEWS,
    ).replace("SELECT s.city, fold,", "SELECT s.city, cast(fold AS int) AS fold,", 1)
)
def ridge_cross_validation(spark, folder):
    _, metrics = linear.cross_validated_ridge(stored_days(spark, folder), PAIR, TARGET, DAYS)
    return rounded(metrics, {"rmse": 4, "mae": 4, "r2": 4})


def _scaled_sql(c):
    return f"round(({c} - avg({c}) FILTER (NOT is_test) OVER w) / coalesce(nullif(stddev_pop({c}) FILTER (NOT is_test) OVER w, 0), 1), 4) AS {c}"


@query(
    with_series(
        f"SELECT date, city, is_test, {', '.join(map(_scaled_sql, FEATURES))} FROM split WINDOW w AS (PARTITION BY city)",
        **DAY_VIEWS,
        split=HOLDOUT_SQL,
    )
)
def standard_scaler_all_features(spark, folder):
    """All 16 features by the statistics of the training rows; a constant one is only centred."""
    split = settle(with_holdout(complete_days(spark, folder).select("date", "city", *FEATURES), 0.2, DAYS))
    stats = linear.scaler_stats(split.where(~F.col("is_test")), FEATURES, ["city"])
    scaled = linear.standardized(split, stats, FEATURES, ["city"], spread=["date"])
    return rounded(scaled.select("date", "city", "is_test", *FEATURES), dict.fromkeys(FEATURES, 4))


PHI_SQL = " UNION ALL ".join(
    f"SELECT c.city, date, 'ridge' AS model, '{c}' AS feature, {c} AS value, w{i} / s{i} * ({c} - avg_{c}) AS phi "
    f"FROM complete AS c JOIN ridge ON c.city = ridge.city AND fold = 0 "
    f"JOIN (SELECT city, avg({c}) AS avg_{c} FROM complete GROUP BY city) AS a ON c.city = a.city"
    for i, c in enumerate(PAIR, 1)
)


def _phis(spark, folder):
    features, refit = _scored_by_refit(spark, folder)
    return linear.linear_attribution(features, refit, PAIR, DAYS)


@query(
    with_series(
        "SELECT city, date, model, feature, value, round(phi, 4) AS phi FROM phis", **RIDGE_VIEWS, phis=PHI_SQL
    )
)
def linear_attribution(spark, folder):
    return rounded(_phis(spark, folder), {"phi": 4})


@query(
    with_series(
        "SELECT city, model, feature, round(m, 4) AS mean_abs_phi, "
        "cast(row_number() OVER (PARTITION BY city ORDER BY m DESC) AS int) AS rank FROM "
        "(SELECT city, model, feature, avg(abs(phi)) AS m FROM phis GROUP BY city, model, feature)",
        **RIDGE_VIEWS,
        phis=PHI_SQL,
    )
)
def attribution_ranking(spark, folder):
    return rounded(attribution.ranked_attribution(_phis(spark, folder)), {"mean_abs_phi": 4})


@query()
def ridge_all_features(spark, folder):
    """Coefficients of every city and fold on the whole feature list."""
    return linear.coefficient_rows(linear.fit_ridge(complete_days(spark, folder), FEATURES, TARGET, DAYS), DAYS)


@query(
    with_series(
        "SELECT city, cast(fold AS int) AS fold, count(*) AS rows, 0.0::DOUBLE AS worst FROM blocked "
        "JOIN (SELECT unnest(range(0, 6)) AS fold) ON fold = 0 OR block < fold GROUP BY city, fold",
        **DAY_VIEWS,
        blocked=BLOCK_SQL.format(source="complete"),
    )
)
def ridge_normal_equations(spark, folder):
    """Fits on all features: how far the worst normal equation of each city and fold is from 0."""
    features = stored_days(spark, folder)
    models = settle(linear.fit_ridge(features, FEATURES, TARGET, DAYS))
    blocked = stored(with_blocks(features, DAYS, SPLITS), "blocked")
    fold = F.explode(F.sequence(F.lit(linear.REFIT), F.lit(SPLITS)))
    used = blocked.withColumn("fold", fold).where((F.col("fold") == linear.REFIT) | (F.col("block") < F.col("fold")))
    z = F.zip_with(F.zip_with(F.array(*FEATURES), "means", lambda x, m: x - m), "scales", lambda x, s: x / s)
    joined = used.join(F.broadcast(models), ["city", "fold"]).withColumn("z", z)  # a row per city and fold
    fitted = F.col("intercept") + F.aggregate(F.zip_with("z", "coefs", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    sums = [F.sum(F.col("z")[j] * (F.col(TARGET) - fitted)) - F.first("coefs")[j] for j in range(len(FEATURES))]
    worst = F.array_max(F.transform(F.array(*sums), F.abs)) / F.count("*")
    found = joined.groupBy("city", "fold").agg(F.count("*").alias("rows"), worst.alias("worst"))
    return rounded(found.withColumn("worst", F.abs("worst")), {"worst": 4})


def _all_by_refit(spark, folder):
    """Complete rows and the refitted model on all features of every city."""
    features = stored_days(spark, folder)
    models = settle(linear.fit_ridge(features, FEATURES, TARGET, DAYS))
    return features, models.where(F.col("fold") == linear.REFIT)


@query()
def linear_attribution_all_features(spark, folder):
    features, refit = _all_by_refit(spark, folder)
    return linear.linear_attribution(features, refit, FEATURES, DAYS)


@query(with_series("SELECT date, city, cast(16 AS bigint) AS features, 0.0::DOUBLE AS gap FROM complete", **DAY_VIEWS))
def linear_attribution_adds_up(spark, folder):
    """The values of a row less its prediction plus the mean prediction of its city."""
    features, refit = _all_by_refit(spark, folder)
    phis = linear.linear_attribution(features, refit, FEATURES, DAYS)
    sums = phis.groupBy("city", "date").agg(F.sum("phi").alias("phi"), F.count("phi").alias("features"))
    scored = settle(linear.score_linear(features, refit, FEATURES, DAYS).select("city", "date", "ridge_pred"))
    base = scored.groupBy("city").agg(F.avg("ridge_pred").alias("base"))
    joined = sums.join(scored, ["city", "date"]).join(F.broadcast(base), "city")  # a row per city
    gap = F.abs(F.round(F.col("phi") - F.col("ridge_pred") + F.col("base"), 4))
    return joined.select("date", "city", "features", gap.alias("gap"))


@query()
def attribution_ranking_all_features(spark, folder):
    """Ranks 1 to 16 of every city."""
    features, refit = _all_by_refit(spark, folder)
    return attribution.ranked_attribution(linear.linear_attribution(features, refit, FEATURES, DAYS))


@query(
    with_series(
        "SELECT date, city, 0.0::DOUBLE AS stored_gap, 0.0::DOUBLE AS newest_gap FROM "
        "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM complete) WHERE back = 1 "
        "UNION ALL SELECT date, city, 0.0::DOUBLE, NULL FROM "
        "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM complete) WHERE back > 1",
        **DAY_VIEWS,
    )
)
def stored_scores_all_features(spark, folder):
    """Scores of every row by the stored model, and of the newest rows by themselves, less the
    prediction written out over the arrays of the fitted model."""
    features, refit = _all_by_refit(spark, folder)
    path = new_folder(spark, "models")
    files.write_models(refit, path)
    models = files.read_models(spark, path)
    again = linear.score_linear(features, models, linear.stored_features(models), DAYS).select("city", "date", "ridge_pred")
    newest = score.latest_forecast(features, DAYS, ridge=refit).withColumnRenamed("ridge_pred", "newest")
    z = F.zip_with(F.zip_with(F.array(*FEATURES), "means", lambda x, m: x - m), "scales", lambda x, s: x / s)
    terms = F.zip_with(z, "coefs", lambda a, b: a * b)
    direct = F.col("intercept") + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    written = features.join(F.broadcast(refit), "city").select("city", "date", direct.alias("direct"))  # a row per city
    joined = written.join(again, ["city", "date"], "left").join(newest, ["city", "date"], "left")
    gaps = {n: F.abs(F.round(F.col(c) - F.col("direct"), 4)).alias(n) for n, c in (("stored_gap", "ridge_pred"), ("newest_gap", "newest"))}
    return joined.select("date", "city", *gaps.values())


@query()
def ridge_cv_averages(spark, folder):
    _, metrics = linear.cross_validated_ridge(stored_days(spark, folder), FEATURES, TARGET, DAYS)
    return cv_average(metrics)


def _ridge_forecast(spark, folder):
    history, ahead = history_and_forecast(spark, folder)
    features = stored_days(spark, folder)
    models = settle(linear.fit_ridge(features, PAIR, TARGET, DAYS))
    return features, models, frames.forecast_frame(history, ahead, DAYS)


@query(
    with_series(
        "SELECT date, v.city, round(y + w1 * (pm10 - m1) / s1 + w2 * (lagged - m2) / s2, 4) AS ridge_pred FROM "
        "(SELECT a.date, a.city, a.pm10, coalesce(h.us_aqi, newest.us_aqi) AS lagged FROM "
        "(SELECT *, 73 - back AS i FROM placed WHERE back <= 72) AS a "
        "LEFT JOIN (SELECT city, us_aqi, 97 - back AS i FROM placed WHERE back BETWEEN 73 AND 96) AS h "
        "ON a.city = h.city AND a.i = h.i "
        "JOIN (SELECT city, us_aqi FROM placed WHERE back = 73) AS newest ON a.city = newest.city) AS v "
        "JOIN ridge ON v.city = ridge.city AND fold = 0",
        **RIDGE_VIEWS,
        placed="SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM series_days",
    )
)
def forecast_scoring(spark, folder):
    """The 72-row forecast frame scored by each city's refitted model."""
    _, models, frame = _ridge_forecast(spark, folder)
    return rounded(score.forecasts(frame, ridge=models, features=PAIR, series=DAYS), {"ridge_pred": 4})


@query(
    with_series(
        "SELECT date, c.city, round(y + w1 * (pm10 - m1) / s1 + w2 * (aqi_lag_24 - m2) / s2, 4) AS ridge_pred FROM "
        "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM complete) AS c "
        "JOIN ridge ON c.city = ridge.city AND fold = 0 WHERE back = 1",
        **RIDGE_VIEWS,
    )
)
def latest_row_scoring(spark, folder):
    features, refit = _scored_by_refit(spark, folder)
    return rounded(score.latest_forecast(features, DAYS, ridge=refit, features=PAIR), {"ridge_pred": 4})


@query(
    with_series(
        "SELECT date, c.city, round(y + w1 * (pm10 - m1) / s1 + w2 * (aqi_lag_24 - m2) / s2, 4) AS ridge_pred "
        "FROM complete AS c JOIN ridge ON c.city = ridge.city WHERE fold = 0",
        **RIDGE_VIEWS,
    )
)
def stored_model_scoring(spark, folder):
    """Refit written to storage, read back with its feature list, and applied."""
    features, refit = _scored_by_refit(spark, folder)
    path = new_folder(spark, "models")
    files.write_models(refit, path)
    models = files.read_models(spark, path)
    scored = linear.score_linear(features, models, linear.stored_features(models), DAYS)
    return rounded(scored.select("date", "city", "ridge_pred"), {"ridge_pred": 4})


@query()
def forest_forecast(spark, folder):
    """Forest and ridge of every city, fitted on its whole history, on the forecast frame."""
    history, ahead = history_and_forecast(spark, folder)
    features = stored(complete_days(spark, folder), "features")
    frame = frames.forecast_frame(history, ahead, DAYS)
    pieces = forest.fit_forest(features, FEATURES, TARGET, DAYS)
    ridge = settle(linear.fit_ridge(features, FEATURES, TARGET, DAYS))
    return score.forecasts(settle(frame), forest=pieces, ridge=ridge, series=DAYS)


@query()
def three_model_forecast(spark, folder):
    """Forest, ridge and kernel regression of every city on the forecast frame, with the alert."""
    history, ahead = history_and_forecast(spark, folder)
    features = stored(complete_days(spark, folder), "features")
    pieces = forest.fit_forest(features, FEATURES, TARGET, DAYS)
    ridge = settle(linear.fit_ridge(features, FEATURES, TARGET, DAYS))
    support = kernel.fit_kernel(features, FEATURES, TARGET, LARGE_SLOTS)
    frame = settle(frames.forecast_frame(history, ahead, DAYS))
    made = score.forecasts(frame, forest=pieces, ridge=ridge, kernel=support, series=LARGE_SLOTS)
    return made.withColumn("hazardous", is_hazardous(F.greatest(*PREDICTIONS)))


# fixed values: the columns of the two older trainers
SIX = ["hour", "day", "month", "pm10", "pm2_5", "aqi_change"]


@query()
def horizon_forecast(spark, folder):
    """The 72-steps-ahead model: the newest row of every city, its prediction and the alert."""
    table = stored(horizon_features(series_days(spark, folder), DAYS, rows=frames.HORIZON_ROWS), "horizon")
    models = settle(linear.fit_ridge(table, SIX, "target_aqi", DAYS)).where(F.col("fold") == linear.REFIT)
    newest = frames.last_rows(table.where(F.col("aqi_change").isNotNull()), 1, DAYS)
    scored = linear.score_linear(newest, models, SIX, DAYS, name="predicted_aqi")
    return scored.select("city", "date", TARGET, "predicted_aqi", is_hazardous("predicted_aqi").alias("hazardous"))


@query()
def five_feature_model(spark, folder):
    """The older trainer: unscaled ridge of the mean of pm10 and pm2_5 on five columns, by city."""
    days = series_days(spark, folder)
    table = days.withColumns(
        {"hour": F.hour("date"), "day": F.dayofmonth("date"), "month": F.month("date"), "mean_reading": row_mean("pm10", "pm2_5")}
    )
    five = ["pm10", "pm2_5", "hour", "day", "month"]
    fit = linear.fit_ridge(stored(table, "five"), five, "mean_reading", DAYS, scaled=False)
    return linear.coefficient_rows(fit, DAYS)


@query()
def tree_fit_metrics(spark, folder):
    """Cross-validation of a single decision tree."""
    days = stored_days(spark, folder)
    _, metrics = forest.cross_validated_forest(days, FEATURES, TARGET, DAYS, model="tree", trees=1, bootstrap=False)
    return cv_average(metrics)


@query(
    with_series(
        "SELECT t.city, model, rows, CASE model WHEN 'ridge' THEN round(rmse, 4) END AS ridge_rmse, "
        "CASE model WHEN 'ridge' THEN round(r2, 4) END AS ridge_r2, cast(1 AS bigint) AS chosen_models, TRUE AS is_best FROM "
        "(SELECT city, count(*) AS rows FROM blocked WHERE block > 0 GROUP BY city) AS t "
        "JOIN (SELECT city, avg(rmse) AS rmse, avg(r2) AS r2 FROM (SELECT b.city, fold, sqrt(avg(e * e)) AS rmse, "
        "1 - sum(e * e) / (var_pop(us_aqi) * count(*)) AS r2 FROM "
        "(SELECT b.city, fold, us_aqi, us_aqi - (y + w1 * (pm10 - m1) / s1 + w2 * (aqi_lag_24 - m2) / s2) AS e "
        "FROM blocked AS b JOIN ridge ON b.city = ridge.city AND b.block = fold WHERE fold > 0) AS b GROUP BY b.city, fold) "
        "GROUP BY city) AS m ON t.city = m.city CROSS JOIN (SELECT unnest(['random_forest', 'ridge', 'svr']) AS model)",
        **RIDGE_VIEWS,
    )
)
def trained_models(spark, folder):
    """The trainer end to end: forest, ridge and kernel regression on every fold, their metrics through JSON
    files, and the choice. The two features are those that SQL can fit a ridge on; ``is_best`` compares the
    chosen model's R2 with the greatest of its city."""
    days = stored_days(spark, folder)
    predictions = stored(selection.fold_predictions(days, PAIR, TARGET, LARGE_SLOTS, forest={"trees": 20}, kernel={"components": 64, "rounds": 3}), "predictions")
    rows = predictions.groupBy("city", "model").agg(F.count("pred").alias("rows"))
    judged = selection.judged_models(spark, predictions, new_folder(spark, "metrics"), DAYS).join(rows, ["city", "model"])
    city = Window.partitionBy("city")
    best = F.max(F.when(F.col("chosen"), F.col("avg_r2"))).over(city) == F.max("avg_r2").over(city)
    ridge = [F.when(F.col("model") == "ridge", F.round(c, 4)).alias(n) for c, n in (("avg_rmse", "ridge_rmse"), ("avg_r2", "ridge_r2"))]
    return judged.select("city", "model", "rows", *ridge, F.count_if("chosen").over(city).alias("chosen_models"), best.alias("is_best"))


IN_LEAF = ["pm10", "dust", "uv_index", "ozone"]


@query(
    with_series(
        f"SELECT date, city, us_aqi, round(avg(us_aqi) OVER (PARTITION BY city, {', '.join(IN_LEAF)}), 4) AS pred FROM shipment_ticks"
    )
)
def tick_tree_fit(spark, folder):
    """One full tree of every tick station: a leaf holds the rows that no reading tells apart, and a row
    is predicted by their mean."""
    ticks = stored_ticks(spark, folder, *IN_LEAF, TARGET)
    pieces = forest.fit_forest(ticks, IN_LEAF, TARGET, TICKS, trees=1, bootstrap=False, depth=60)
    scored = forest.score_forest(ticks, pieces, IN_LEAF, TICKS, name="pred")
    return rounded(scored.select("date", "city", TARGET, "pred"), {"pred": 4})


@query()
def kernel_cv_averages(spark, folder):
    _, metrics = kernel.cross_validated_kernel(
        stored_days(spark, folder), FEATURES, TARGET, LARGE_SLOTS
    )
    return cv_average(metrics)


def _shapley_inputs(spark, folder):
    """Forecast frame, its background, and a scorer by forests of all features."""
    history, ahead = history_and_forecast(spark, folder)
    features = stored(complete_days(spark, folder), "features")
    pieces = forest.fit_forest(features, FEATURES, TARGET, DAYS)

    def scorer(df):
        return forest.score_forest(df, pieces, FEATURES, DAYS, name="pred")

    return settle(frames.forecast_frame(history, ahead, DAYS)), features, scorer


@query()
def sampled_shapley(spark, folder):
    """Sampled attribution of a forest on the forecast frame."""
    frame, features, scorer = _shapley_inputs(spark, folder)
    return attribution.sampled_shapley(frame, features, FEATURES, scorer, DAYS)


@query(
    with_series(
        "SELECT date, city, cast(16 AS bigint) AS features, 0.0::DOUBLE AS gap FROM placed WHERE back <= 72",
        placed="SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM series_days",
    )
)
def shapley_adds_up(spark, folder):
    """The values of a row less its prediction plus the mean prediction of its drawn background."""
    frame, features, scorer = _shapley_inputs(spark, folder)
    phis = attribution.sampled_shapley(frame, features, FEATURES, scorer, DAYS)
    sums = phis.groupBy("city", "date").agg(F.sum("phi").alias("phi"), F.count("*").alias("features"))
    drawn = attribution.drawn_background(frame, features, FEATURES, DAYS)
    drawn = drawn.select("city", "date", *[F.col("_base")[j].alias(c) for j, c in enumerate(FEATURES)])
    base = scorer(drawn).groupBy("city", "date").agg(F.avg("pred").alias("base"))
    joined = sums.join(base, ["city", "date"]).join(scorer(frame).select("city", "date", "pred"), ["city", "date"])
    gap = F.abs(F.round(F.col("phi") - F.col("pred") + F.col("base"), 4))
    return joined.select("date", "city", "features", gap.alias("gap"))


FOUR = ["pm10", "pm2_5", "dust", "ozone"]


def _products(df):
    """A model whose features act in pairs."""
    return df.withColumn("pred", F.col("pm10") * F.col("pm2_5") + 2 * F.col("dust") * F.col("ozone"))


@query(
    with_series(
        "SELECT date, city, feature, 0.0::DOUBLE AS gap, true AS has_error "
        f"FROM series_days, (VALUES {', '.join(f"('{c}')" for c in FOUR)}) AS four(feature)"
    )
)
def paired_shapley_closed_form(spark, folder):
    """Paired attribution of products of two features less the closed form over the same draws."""
    days = stored(series_days(spark, folder), "days")
    phis = attribution.sampled_shapley(days, days, FOUR, _products, DAYS, permutations=5, paired=True)
    drawn = attribution.drawn_background(days, days, FOUR, DAYS, permutations=5)

    def share(a, b, weight):
        x, base = F.col("_x"), F.col("_base")
        return weight * (x[a] - base[a]) * (x[b] + base[b]) / 2

    exact = F.array(share(0, 1, 1), share(1, 0, 1), share(2, 3, 2), share(3, 2, 2))
    named = drawn.select("city", "date", F.posexplode(exact).alias("_j", "share"))
    named = named.withColumn("feature", F.get(F.array(*[F.lit(c) for c in FOUR]), F.col("_j")))
    means = named.groupBy("city", "date", "feature").agg(F.avg("share").alias("share"))
    gap = F.abs(F.round(F.col("phi") - F.col("share"), 4))
    joined = phis.join(means, ["city", "date", "feature"])
    return joined.select("date", "city", "feature", gap.alias("gap"), (F.col("se") >= 0).alias("has_error"))
