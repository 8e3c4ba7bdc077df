"""Statistics, filters and column functions against pandas and at their edges."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazecast.functions import columns as fn
from hazecast.operators import lookup as lookup_module
from hazecast.operators import stats
from hazecast.operators.frames import trailing
from hazecast.operators.lookup import lookup, salted_join
from hazecast.operators.quantiles import quantiles


def sample(spark, n=30_000, seed=2):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"city": rng.choice(["hot", "b"], n, p=[0.98, 0.02]), "v": rng.gamma(2.0, 50.0, n)})
    frame.loc[rng.random(n) < 0.1, "v"] = np.nan
    frame = pd.concat([frame, pd.DataFrame({"city": ["one", "two", "two"], "v": [3.0, 1.0, 2.0]})])
    frame["w"] = frame["v"].round(-1)
    return frame, fn.nan_to_null(spark.createDataFrame(frame))


@pytest.mark.parametrize("accuracy", [100, 10_000])
@pytest.mark.parametrize("broadcast", [True, False])
def test_quantiles_are_exact(spark, monkeypatch, accuracy, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup_module, "fits_broadcast", lambda *a: False)
    frame, df = sample(spark)
    got = quantiles(df, ["v", "w"], ["city"], (0.01, 0.25, 0.5, 0.75, 1.0), accuracy=accuracy).collect()
    assert len(got) == 4 * 2 * 5
    for r in got:
        want = frame.loc[frame.city == r["city"], r["column"]].quantile(r["q"])
        assert r["value"] == pytest.approx(want, rel=1e-12), r


def test_describe_matches_pandas(spark):
    frame, df = sample(spark, 3000)
    got = stats.describe(df, ["v", "w"]).toPandas()
    for city, g in frame.groupby("city"):
        want = g[["v", "w"]].describe()
        for c in ("v", "w"):
            row = got[(got.city == city) & (got["column"] == c)].iloc[0]
            mine = [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]]
            np.testing.assert_allclose(np.array(mine, float), want[c].to_numpy())


def test_correlations_skip_missing_pairs(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(200, 3)), columns=["x", "y", "z"])
    frame["city"] = "a"
    frame.loc[::3, "x"] = np.nan
    frame.loc[::5, "y"] = np.nan
    got = stats.correlations(fn.nan_to_null(spark.createDataFrame(frame)), ["x", "y", "z"]).toPandas()
    want = frame[["x", "y", "z"]].corr()
    for r in got.itertuples():
        assert r.r == pytest.approx(want.loc[r.x, r.y])


def test_histogram_of_equal_values_and_totals(spark):
    df = spark.createDataFrame([("a", 5.0)] * 4 + [("b", float(v)) for v in range(81)], "city string, us_aqi double")
    got = stats.histogram(df).toPandas()
    assert list(got.groupby("city")["rows"].sum()) == [4, 81] and len(got) == 80
    assert got[(got.city == "a") & (got["bin"] == 1)]["rows"].item() == 4
    assert got[(got.city == "b") & (got["bin"] == 40)]["rows"].item() == 3


def test_box_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "city string, us_aqi double")
    row = stats.box_summary(df).first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 4.0, 1)


def test_level_bounds(spark):
    values = [0.0, 49.9, 50.0, 100.0, 150.0, 200.0, 300.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fn.aqi_level("v")).collect()]
    assert got == [
        "Good", "Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy",
        "Hazardous", None, None,
    ]
    strict = [r[0] for r in df.select(fn.aqi_level("v", strict_reference=True)).collect()]
    assert strict[-2:] == ["Hazardous", "Hazardous"]
    assert [r[0] for r in df.select(fn.is_hazardous("v")).collect()][2:5] == [False, False, True]


def test_row_mean_and_bad_times(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "pm10 double, pm2_5 double")
    assert [r[0] for r in df.select(fn.row_mean("pm10", "pm2_5")).collect()] == [2.0, 3.0, None]
    texts = spark.createDataFrame([("2025-08-25 00:00:00+00:00",), ("soon",), (None,)], "t string")
    got = [r[0] for r in texts.select(fn.parsed_time("t").cast("string")).collect()]
    assert got == ["2025-08-25 00:00:00", None, None]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "date timestamp")
    assert [r[0] for r in df.select(fn.calendar_columns()["day_of_week"]).collect()] == [0, 6]


def test_trailing_bound_is_inclusive(spark):
    days = [dt.datetime(2024, 1, d, h) for d, h in [(1, 0), (1, 1), (2, 0), (4, 1)]]
    df = spark.createDataFrame([("a", d) for d in days], "city string, date timestamp")
    assert trailing(df).count() == 3


def test_validation_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="us_aqi"):
        fn.validated(spark.range(1))
    with pytest.raises(ValueError, match="numeric"):
        fn.validated(spark.range(1).select(F.lit(1.0).alias("us_aqi"), F.lit("x").alias("city")))


def test_salted_join_gives_the_same_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("city"), "id")
    small = df.select("city").distinct().where("city != '9'").withColumn("n", F.length("city"))
    plain = lookup(df, small, ["city"])
    salted = salted_join(df, small, ["city"], spread=["id"])
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, salted.collect()), key=str)
    assert plain.columns == ["city", "id", "n"]
    assert lookup(df.select("id", "city"), small, ["city"]).columns == ["id", "city", "n"]
    assert salted.count() == 5000 and salted.where("n is null").count() == 1


def test_last_rows_limit_before_the_shuffle(spark, small):
    from hazecast.operators.frames import last_rows
    from hazecast.sources.tables import table

    events = table(spark, small, "events").select(F.col("event_type").alias("city"), F.col("ts").alias("date"))
    plan = last_rows(events, 48)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit") and "Partial" in plan


@pytest.mark.parametrize("kind", ["normal", "ties", "spike"])
def test_wide_bands_are_ranked_range_by_range(spark, kind):
    """A coarse sketch leaves bands of thousands of values; most of a spike lies on one value."""
    rng = np.random.default_rng(8)
    values = {"normal": rng.normal(size=30_000), "ties": rng.integers(0, 40, 30_000) * 1.0, "spike": np.where(rng.random(30_000) < 0.6, 5.0, rng.normal(5, 1e-9, 30_000))}[kind]
    df = spark.createDataFrame(pd.DataFrame({"city": "a", "x": values})).union(spark.sql("SELECT 'b', 1.0D"))
    got = {(r.city, r.q): r.value for r in quantiles(df, ["x"], ["city"], (0.0, 0.1, 0.5, 0.999, 1.0), accuracy=20).collect()}
    for q in (0.0, 0.1, 0.5, 0.999, 1.0):
        assert got["a", q] == pytest.approx(np.quantile(values, q), rel=1e-15, abs=1e-15) and got["b", q] == 1.0


def test_only_large_groups_get_bands(spark, monkeypatch):
    import hazecast.operators.quantiles as module

    seen, real = [], module._bands
    monkeypatch.setattr(module, "_bands", lambda *args: seen.append(real(*args)) or seen[-1])
    rows = [(f"S{k}", float(v)) for k in range(30) for v in range(k % 4 + 1)] + [("hub", float(v * v)) for v in range(101)]
    rows += [("S1", None), ("empty", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "city string, x double")
    got = {(r.city, r.q): r.value for r in module.quantiles(df, ["x"], ["city"], (0.25, 0.5), accuracy=20).collect()}
    assert [r.city for bands in seen for r in bands.collect()] == ["hub"]
    own = {}
    for city, value in rows:
        if city is not None and value is not None:
            own.setdefault(city, []).append(value)
    assert got == {(c, q): np.quantile(v, q) for c, v in own.items() for q in (0.25, 0.5)}
