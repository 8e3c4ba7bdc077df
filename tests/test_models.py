"""Splits, fits, scores and attributions against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazecast.models import attribution, evaluate, folds, kernel, linear, score, trees
from hazecast.operators.layout import DAY, Series

NAMES = ["f0", "f1", "f2", "f3"]
SERIES = Series(slot_seconds=20 * DAY)


def training(n=200, cities=("a", "b"), seed=3):
    rng = np.random.default_rng(seed)
    parts = []
    for k, city in enumerate(cities):
        x = rng.normal(size=(n, 4)) * [1, 10, 100, 1] + [0, 5, 1000, k]
        x[:, 3] = 7.0 + k  # constant
        y = x[:, 0] * 3 - x[:, 1] + 0.02 * x[:, 2] + 0.5 * np.sin(3 * x[:, 0]) + rng.normal(size=n)
        part = pd.DataFrame(x, columns=NAMES)
        part["us_aqi"], part["city"] = y, city
        part["date"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="D")
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


def direct_ridge(x, y, alpha=1.0, scaled=True):
    mean = x.mean(0)
    scale = x.std(0) if scaled else np.ones(x.shape[1])
    scale = np.where(scale < 1e-12, 1.0, scale)
    z = (x - mean) / scale
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return lambda q: y.mean() + ((q - mean) / scale) @ w, w


def fold_bounds(n, splits=5):
    size = n // (splits + 1)
    return [(n - (splits + 1 - k) * size, n - (splits - k) * size) for k in range(1, splits + 1)]


@pytest.mark.parametrize("n", [200, 6, 7, 5, 1])
def test_blocks_are_expanding_folds(spark, n):
    df = spark.createDataFrame(training(n))
    got = folds.with_blocks(df, SERIES).where("city = 'a'").orderBy("date").toPandas()
    want = np.zeros(n, int)
    if n >= 6:
        for k, (low, high) in enumerate(fold_bounds(n), 1):
            want[low:high] = k
    assert list(got["block"]) == list(want)
    if n == 200:
        assert [b[0] for b in fold_bounds(n)] == [35, 68, 101, 134, 167]


@pytest.mark.parametrize("n", [200, 11, 1])
def test_holdout_is_the_newest_fifth(spark, n):
    got = folds.with_holdout(spark.createDataFrame(training(n)), 0.2, SERIES)
    got = got.where("city = 'b'").orderBy("date").toPandas()
    tests = int(np.ceil(0.2 * n))
    assert list(got["is_test"]) == [False] * (n - tests) + [True] * tests


def test_random_split_is_stable(spark):
    df = spark.createDataFrame(training())
    one = folds.with_random_split(df, 0.2, 42).orderBy("city", "date").toPandas()
    two = folds.with_random_split(df.repartition(7), 0.2, 42).orderBy("city", "date").toPandas()
    assert list(one["is_test"]) == list(two["is_test"])
    assert 0.1 < one["is_test"].mean() < 0.3


@pytest.mark.parametrize("scaled", [True, False])
def test_ridge_equals_direct_solve_in_every_fold(spark, scaled):
    frame = training()
    models = linear.fit_ridge(spark.createDataFrame(frame), NAMES, series=SERIES, scaled=scaled).toPandas()
    assert len(models) == 12
    for city, g in frame.groupby("city"):
        x, y = g[NAMES].to_numpy(), g["us_aqi"].to_numpy()
        for fold in range(6):
            stop = len(g) if fold == 0 else fold_bounds(200)[fold - 1][0]
            _, w = direct_ridge(x[:stop], y[:stop], scaled=scaled)
            row = models[(models.city == city) & (models.fold == fold)].iloc[0]
            np.testing.assert_allclose(row.coefs, w, rtol=1e-8, atol=1e-8)
            assert row.rows == stop and list(row.features) == NAMES


def test_cross_validation_metrics(spark):
    frame = training()
    _, metrics = linear.cross_validated_ridge(spark.createDataFrame(frame), NAMES, series=SERIES)
    got = evaluate.cv_average(metrics).orderBy("city").toPandas()
    for city, g in frame.groupby("city"):
        x, y = g[NAMES].to_numpy(), g["us_aqi"].to_numpy()
        rows = []
        for low, high in fold_bounds(200):
            predict, _ = direct_ridge(x[:low], y[:low])
            e = y[low:high] - predict(x[low:high])
            rest = y[low:high] - y[low:high].mean()
            rows.append([np.sqrt((e**2).mean()), np.abs(e).mean(), 1 - (e**2).sum() / (rest**2).sum()])
        mine = got[got.city == city][["avg_rmse", "avg_mae", "avg_r2"]].to_numpy()[0]
        np.testing.assert_allclose(mine, np.mean(rows, axis=0), rtol=1e-9)


def test_metric_edges(spark):
    rows = [("exact", 5.0, 5.0)] * 3 + [("constant", 5.0, 4.0)] * 3 + [("single", 5.0, 4.0)] + [("gap", None, 1.0)]
    df = spark.createDataFrame(rows, "model string, us_aqi double, pred double")
    got = {r["model"]: r for r in evaluate.regression_metrics(df, ["model"]).collect()}
    assert got["exact"]["r2"] == 1.0 and got["constant"]["r2"] == 0.0
    assert got["single"]["r2"] is None and got["constant"]["rmse"] == 1.0
    assert "gap" not in got


def test_first_model_wins_a_tie(spark):
    rows = [("a", "svr", 0.5), ("a", "ridge", 0.5), ("a", "random_forest", 0.1), ("b", "svr", 0.9), ("b", "ridge", None)]
    df = spark.createDataFrame(rows, "city string, model string, avg_r2 double")
    assert {r["city"]: r["model"] for r in evaluate.best_model(df).collect()} == {"a": "ridge", "b": "svr"}


def test_attribution_adds_up_to_the_prediction(spark):
    df = spark.createDataFrame(training())
    refit = linear.fit_ridge(df, NAMES, series=SERIES).where("fold = 0")
    scored = linear.score_linear(df, refit, NAMES, SERIES)
    mean = scored.groupBy("city").agg(F.avg("ridge_pred").alias("mean"))
    sums = linear.linear_attribution(df, refit, NAMES, SERIES).groupBy("city", "date").agg(F.sum("phi").alias("s"))
    off = scored.join(mean, "city").join(sums, ["city", "date"])
    assert off.select(F.max(F.abs(F.col("s") + F.col("mean") - F.col("ridge_pred")))).first()[0] < 1e-8


def test_missing_feature_gives_null_score(spark):
    frame = training(60)
    df = spark.createDataFrame(frame)
    refit = linear.fit_ridge(df, NAMES, series=SERIES).where("fold = 0")
    holes = df.withColumn("f0", F.when(F.dayofmonth("date") != 5, F.col("f0")))
    scored = linear.score_linear(holes, refit, NAMES, SERIES)
    assert scored.where("f0 is null and ridge_pred is null").count() == holes.where("f0 is null").count() > 0
    forest = trees.fit_trees(df, trees.random_forest(trees=3, depth=3), NAMES, series=SERIES)
    by_tree = trees.score_trees(holes, forest, NAMES, SERIES)
    assert by_tree.where("(f0 is null) = (random_forest_pred is null)").count() == 120


def test_kernel_is_close_to_the_exact_fit(spark):
    rng = np.random.default_rng(1)
    n = 600
    x = rng.normal(size=(n, 2))
    y = 20 * np.sin(x[:, 0]) + 10 * x[:, 1] ** 2
    frame = pd.DataFrame(x, columns=["f0", "f1"])
    frame["us_aqi"], frame["city"] = y, "a"
    frame["date"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="D")
    df = spark.createDataFrame(frame)
    models = kernel.fit_kernel(df, ["f0", "f1"], series=Series(slot_seconds=100 * DAY), components=256, rounds=6)
    scored = kernel.score_kernel(df, models, ["f0", "f1"], Series(slot_seconds=50 * DAY))
    metrics = evaluate.regression_metrics(scored, ["city"], "svr_pred").first()
    straight, _ = direct_ridge(x, y)
    linear_rmse = np.sqrt(((y - straight(x)) ** 2).mean())
    assert metrics["rmse"] < 0.2 * linear_rmse and metrics["r2"] > 0.95
    assert models.count() == 6


def test_kernel_scores_do_not_depend_on_slots(spark):
    df = spark.createDataFrame(training(120))
    fits = [
        kernel.fit_kernel(df, NAMES, series=Series(slot_seconds=d * DAY), components=32, rounds=2)
        for d in (10, 1000)
    ]
    one, two = [
        kernel.score_kernel(df, m, NAMES, SERIES).orderBy("city", "date").toPandas()["svr_pred"] for m in fits
    ]
    np.testing.assert_allclose(one, two, rtol=1e-5)


def test_trees_cross_validate_every_station(spark):
    df = spark.createDataFrame(training(90))
    models, metrics = trees.cross_validated_trees(
        df, trees.decision_tree(depth=4), NAMES, series=SERIES, model="tree"
    )
    assert set(models) == {"a", "b"}
    assert metrics.count() == 10


def test_sampled_shapley_adds_up_and_finds_linear_weights(spark):
    frame = training(80)
    df = spark.createDataFrame(frame)
    refit = linear.fit_ridge(df, NAMES, series=SERIES).where("fold = 0")

    def scorer(rows):
        return linear.score_linear(rows, refit, NAMES, SERIES, name="pred")

    explained = df.where(F.dayofmonth("date") == 1)
    phis = attribution.sampled_shapley(
        explained, df, NAMES, scorer, SERIES, permutations=200
    )
    again = attribution.sampled_shapley(
        explained.repartition(5), df.repartition(3), NAMES, scorer, SERIES, permutations=200
    )
    exact = linear.linear_attribution(explained, refit, NAMES, SERIES, background=df)
    a, b, c = [
        p.orderBy("city", "date", "feature").toPandas() for p in (phis, again, exact)
    ]
    assert len(a) == explained.count() * 4
    np.testing.assert_allclose(a["phi"], b["phi"], atol=1e-9)
    assert np.abs(a["phi"] - c["phi"]).max() < 3.0
    assert np.abs(a.loc[a.feature == "f3", "phi"]).max() == 0.0
    ranked = attribution.ranked_attribution(phis).orderBy("city", "rank").toPandas()
    assert list(ranked["rank"]) == [1, 2, 3, 4] * 2
    assert list(ranked.loc[ranked["rank"] == 4, "feature"]) == ["f3", "f3"]
    assert ranked.groupby("city")["mean_abs_phi"].apply(lambda v: v.is_monotonic_decreasing).all()


def test_paired_orders_and_their_standard_error(spark):
    """Exact values by all orders and all background rows lie within the error that is given."""
    import itertools

    df = spark.createDataFrame(training(60)).where(F.col("city") == training(60)["city"].iloc[0])

    def model(row):
        return row[0] * row[1] + row[2] * row[0] * row[1] + row[3]

    def scorer(rows):
        return rows.withColumn("pred", model([F.col(c) for c in NAMES]))

    explained = df.orderBy("date").limit(5)
    background = df.select(*NAMES).toPandas().to_numpy()
    rows = explained.select("date", *NAMES).toPandas()
    exact = {}
    for date, *x in rows.itertuples(index=False):
        total = np.zeros(4)
        for order in itertools.permutations(range(4)):
            now = background.copy()
            before = model(now.T)
            for j in order:
                now[:, j] = x[j]
                after = model(now.T)
                total[j] += (after - before).mean()
                before = after
        exact |= {(date, c): v / 24 for c, v in zip(NAMES, total, strict=True)}

    found = {}
    for paired in (False, True):
        found[paired] = attribution.sampled_shapley(explained, df, NAMES, scorer, SERIES, permutations=150, paired=paired).toPandas()
        z = [(r.phi - exact[r.date, r.feature]) / r.se for r in found[paired].itertuples() if r.se > 1e-12]
        assert len(z) >= 15 and np.abs(z).max() < 4.5 and np.sqrt(np.mean(np.square(z))) < 2
    assert found[True]["se"].mean() < found[False]["se"].mean()
    single = attribution.sampled_shapley(explained, df, NAMES, scorer, SERIES, permutations=1).toPandas()
    assert single["se"].isna().all() and single["phi"].notna().all()


def test_all_models_side_by_side(spark):
    df = spark.createDataFrame(training(100))
    parts = {
        "ridge": linear.fit_ridge(df, NAMES, series=SERIES),
        "forest": trees.fit_trees(df, trees.random_forest(trees=5, depth=4), NAMES, series=SERIES),
        "kernel": kernel.fit_kernel(df, NAMES, series=SERIES, components=32, rounds=2),
    }
    got = score.latest_forecast(df, SERIES, features=NAMES, **parts)
    assert got.columns == ["date", "city", "random_forest_pred", "ridge_pred", "svr_pred"]
    assert got.count() == 2 and got.dropna().count() == 2
    assert score.forecasts(df, ridge=parts["ridge"], features=NAMES, series=SERIES).columns == ["date", "city", "ridge_pred"]


def test_saved_trees_come_back_and_other_stations_score_null(spark, tmp_path):
    from hazecast.models import trees

    df = spark.createDataFrame(training(40)).withColumn("city", F.concat(F.lit("a/b "), "city"))
    names = sorted(r.city for r in df.select("city").distinct().collect())
    fitted = trees.fit_trees(df, trees.random_forest(trees=2, depth=3), NAMES, series=SERIES, names=names[:1])
    trees.save_trees(fitted, f"{tmp_path}/trees")
    loaded = trees.load_trees(spark, f"{tmp_path}/trees")
    assert list(loaded) == names[:1]
    scored = trees.score_trees(df, loaded, NAMES, SERIES).toPandas()
    assert len(scored) == df.count()
    assert scored.loc[scored.city == names[0], "random_forest_pred"].notna().all()
    assert scored.loc[scored.city != names[0], "random_forest_pred"].isna().all()
    assert trees.score_trees(df, {}, NAMES, SERIES).where("random_forest_pred IS NULL").count() == df.count()


def test_rows_without_background_have_null_values(spark):
    df = spark.createDataFrame(training(30))
    names = sorted(r.city for r in df.select("city").distinct().collect())

    def scorer(rows):
        return rows.withColumn("pred", sum(F.col(c) for c in NAMES))

    phis = attribution.sampled_shapley(df, df.where(F.col("city") == names[0]), NAMES, scorer, SERIES, permutations=3).toPandas()
    assert len(phis) == df.count() * len(NAMES)
    assert phis.loc[phis.city == names[0], "phi"].notna().all() and phis.loc[phis.city != names[0], "phi"].isna().all()


def test_every_feature_has_a_rank_in_every_city(spark, small):
    from hazecast.plans import QUERIES
    from hazecast.schemas import FEATURES

    got = QUERIES["attribution_ranking_all_features"].build(spark, small).toPandas()
    assert len(got) == 3 * len(FEATURES)
    for _, own in got.groupby("city"):
        assert sorted(own["rank"]) == list(range(1, 17)) and set(own["feature"]) == set(FEATURES)
