"""Window operators against pandas, across slot boundaries, gaps and short histories."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazecast.functions.columns import nan_to_null
from hazecast.operators import lookup as lookup_module
from hazecast.operators import windows
from hazecast.operators.layout import DAY, Series, row_positions, with_slot
from hazecast.schemas import MEMORY, READINGS

LENGTHS = {"a": 400, "b": 49, "c": 48, "d": 47, "e": 24, "f": 23, "g": 1}


def random_series(seed=5):
    rng = np.random.default_rng(seed)
    parts = []
    for city, n in LENGTHS.items():
        hours = np.sort(rng.choice(n * 6, size=n, replace=False))
        frame = pd.DataFrame({"date": pd.Timestamp("2024-01-01") + pd.to_timedelta(hours, unit="h")})
        for c in READINGS:
            values = rng.integers(0, 300, n).astype(float)
            missing = rng.random(n) < (0.02 if c == "us_aqi" else 0.3)
            frame[c] = np.where(missing, np.nan, values)
        frame["city"] = city
        parts.append(frame)
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, frame):
    return nan_to_null(spark.createDataFrame(frame[["date", *READINGS, "city"]]))


def expected_features(frame, nulls, shift=0):
    done = []
    for _, g in frame.groupby("city"):
        g = g.sort_values("date").copy()
        x = g["us_aqi"]
        past = x.shift(shift)
        g["hour"], g["day_of_week"], g["month"] = g.date.dt.hour, g.date.dt.dayofweek, g.date.dt.month
        g["aqi_lag_24"], g["aqi_lag_48"] = x.shift(24), x.shift(48)
        g["aqi_rolling_24_mean"] = past.rolling(24).mean()
        g["aqi_rolling_24_std"] = past.rolling(24).std()
        before = x.shift(24 + shift)
        g["aqi_change_rate"] = ((past - before) / before).replace([np.inf, -np.inf], np.nan)
        if nulls.startswith("ffill"):
            g = g.ffill()
        if nulls == "ffill_bfill":
            g = g.bfill()
        if nulls.endswith("drop"):
            g = g.dropna()
        done.append(g)
    return pd.concat(done)


def compare(got, want, columns):
    got = got.sort_values(["city", "date"]).reset_index(drop=True)
    want = want.sort_values(["city", "date"]).reset_index(drop=True)
    assert len(got) == len(want)
    assert list(got["city"]) == list(want["city"]) and list(got["date"]) == list(want["date"])
    for c in columns:
        np.testing.assert_allclose(
            got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c
        )


@pytest.mark.parametrize("nulls", ["keep", "drop", "ffill_drop", "ffill_bfill"])
@pytest.mark.parametrize("slot_days", [2, 365])
def test_features_match_pandas(spark, nulls, slot_days):
    frame = random_series()
    series = Series(slot_seconds=slot_days * DAY)
    got = windows.station_features(to_spark(spark, frame), series, nulls=nulls).toPandas()
    want = expected_features(frame, nulls)
    compare(got, want, [*READINGS, "hour", "day_of_week", "month", *MEMORY])


def test_leak_free_features(spark):
    frame = random_series(8)
    got = windows.station_features(
        to_spark(spark, frame), Series(slot_seconds=3 * DAY), nulls="keep", shift=1
    ).toPandas()
    compare(got, expected_features(frame, "keep", shift=1), MEMORY)


@pytest.mark.parametrize("slot_hours", [1, 7, 24, 24 * 400])
def test_lead_and_difference_do_not_depend_on_slots(spark, slot_hours):
    frame = random_series(9)
    series = Series(slot_seconds=slot_hours * 3600)
    got = windows.horizon_features(to_spark(spark, frame), series).toPandas()
    parts = []
    for _, g in frame.groupby("city"):
        g = g.sort_values("date").copy()
        g["aqi_change"] = g.us_aqi.diff().fillna(0)
        g["target_aqi"] = g.us_aqi.shift(-72)
        parts.append(g)
    compare(got, pd.concat(parts), ["aqi_change", "target_aqi", "pm10", "us_aqi"])


def test_fills_cross_empty_slots_and_are_idempotent(spark):
    frame = random_series(10)
    frame.loc[(frame.city == "a") & (frame.index % 3 > 0), "dust"] = np.nan
    frame.loc[(frame.city == "a") & (frame.index < 350), "ozone"] = np.nan
    series = Series(slot_seconds=DAY)
    df = to_spark(spark, frame)
    once = windows.forward_fill(df, ["dust", "ozone"], series)
    twice = windows.forward_fill(once, ["dust", "ozone"], series)
    back = windows.backward_fill(df, ["dust", "ozone"], series)
    for got, method in [(once, "ffill"), (twice, "ffill"), (back, "bfill")]:
        want = frame.sort_values(["city", "date"]).copy()
        for c in ("dust", "ozone"):
            want[c] = getattr(want.groupby("city")[c], method)()
        compare(got.toPandas(), want, ["dust", "ozone", "us_aqi"])
        assert got.columns == df.columns


def test_zero_base_gives_null_change(spark):
    frame = random_series(11)
    frame.loc[frame.city == "a", "us_aqi"] = 0.0
    got = windows.station_features(to_spark(spark, frame), nulls="keep").where("city = 'a'")
    assert got.where("aqi_change_rate is not null").count() == 0


def test_positions_are_row_numbers(spark):
    frame = random_series(12)
    got = row_positions(to_spark(spark, frame), Series(slot_seconds=DAY), ["us_aqi"]).toPandas()
    got = got.sort_values(["city", "date"])
    for city, g in got.groupby("city"):
        assert list(g["_pos"]) == list(range(len(g)))
        assert set(g["_n"]) == {LENGTHS[city]}
        mean = frame.loc[frame.city == city, "us_aqi"].mean()
        np.testing.assert_allclose(g["_mean_us_aqi"].astype(float), mean)


def test_partitioning_of_the_input_does_not_matter(spark):
    df = to_spark(spark, random_series(13))
    series = Series(slot_seconds=2 * DAY)
    one = windows.station_features(df.coalesce(1), series).toPandas()
    many = windows.station_features(df.repartition(17), series).toPandas()
    compare(one, many, MEMORY)


def test_main_rows_are_shuffled_once(spark):
    df = windows.station_features(to_spark(spark, random_series(14)), nulls="ffill_drop")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(city" in plan
    assert "Window" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_only_large_stations_are_cut(spark):
    df = to_spark(spark, random_series(15))
    series = Series(slot_seconds=None, rows_per_slot=60)
    slots = with_slot(df, series).groupBy("city").agg(F.countDistinct("_slot")).collect()
    counts = dict(map(tuple, slots))
    assert 6 <= counts.pop("a") <= 9
    assert set(counts.values()) == {1}
    got = windows.station_features(df, series, nulls="ffill_drop").toPandas()
    compare(got, expected_features(random_series(15), "ffill_drop"), MEMORY)


def test_a_burst_is_cut_as_finely_as_it_is_dense(spark):
    """All but two rows of a station lie within a few minutes; its first and last row are years apart."""
    burst = spark.range(200_000).selectExpr("timestamp_micros(1700000000000000 + id * 1000) AS date", "cast(id % 13 AS double) AS us_aqi", "'a' AS city")
    far = spark.sql("SELECT explode(array(timestamp'1990-01-01', timestamp'2030-01-01')) AS date, 1.0D AS us_aqi, 'a' AS city")
    small = spark.range(100).selectExpr("timestamp_micros(id) AS date", "cast(id AS double) AS us_aqi", "'b' AS city")
    df = burst.union(far).union(small)
    series = Series(slot_seconds=None, rows_per_slot=5000)
    slotted = with_slot(df, series)
    sizes = slotted.groupBy("city", "_slot").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")).toPandas()
    assert sizes.n.max() <= 10_000 and sizes.n.sum() == 200_102 and (sizes.city == "b").sum() == 1
    own = sizes[sizes.city == "a"].sort_values("_slot")
    assert (own["first"].iloc[1:].to_numpy() > own["last"].iloc[:-1].to_numpy()).all()
    lagged = windows.with_lags(df, {"lag": 3}, series)
    wrong = "date > timestamp'2000-01-01' AND date < timestamp'2029-01-01' AND unix_micros(date) >= 1700000000003000 AND lag <> (us_aqi + 10) % 13"
    assert lagged.where(wrong).count() == 0 and lagged.where("lag IS NULL").count() == 6


def test_measured_slots_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "fits_broadcast", lambda *a: False)
    df = to_spark(spark, random_series(16))
    got = windows.station_features(df, Series(slot_seconds=None, rows_per_slot=60)).toPandas()
    compare(got, expected_features(random_series(16), "drop"), MEMORY)


@pytest.mark.parametrize("series", [Series(slot_seconds=7 * DAY), Series(slot_seconds=None, rows_per_slot=200)])
def test_input_is_scanned_and_shuffled_once(spark, tmp_path, series):
    """The feature table reads its input once, and its edge rows from the exchange of the main rows."""
    hours = spark.range(3000).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id AS int)) AS date", "cast(id % 97 AS double) AS us_aqi", "'a' AS city"
    )
    hours.write.parquet(f"{tmp_path}/hours")
    featured = windows.station_features(spark.read.parquet(f"{tmp_path}/hours"), series)
    featured.collect()
    plan = featured._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2  # edge rows, and the summary of the slots
    assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("reverse", [False, True])
def test_no_window_runs_over_the_rows_of_a_station(spark, reverse):
    df = to_spark(spark, random_series(17))
    series = Series(slot_seconds=DAY)
    made = windows.with_target_ahead(df, 5, series) if reverse else windows.with_lags(df, {"lag": 30}, series)
    plan = made._jdf.queryExecution().executedPlan().toString()
    over_station = [line for line in plan.splitlines() if "Window [" in line and re.search(r"\[city#\d+\], \[date", line)]
    assert not over_station
