"""Incremental append, deduplication, files and the stream."""

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazecast.operators import append, windows
from hazecast.operators.layout import Series
from hazecast.plans.common import DAYS
from hazecast.schemas import FORECAST, RAW_HOURS, READINGS
from hazecast.sources import files, payloads
from hazecast.sources.tables import series_days
from hazecast.streaming.append import FeatureStore, append_stream


def hours(spark, first, count, city="a", value=1.0):
    start = dt.datetime(2024, 1, 1)
    rows = [
        (start + dt.timedelta(hours=h), *[value * (h % 17 + 1)] * len(READINGS), city)
        for h in range(first, first + count)
    ]
    return spark.createDataFrame(rows, RAW_HOURS)


def test_high_water_append_is_idempotent(spark):
    stored = hours(spark, 0, 10)
    fetched = hours(spark, 5, 10, value=2.0).unionByName(hours(spark, 0, 3, "new"))
    once = append.appended(stored, fetched)
    assert once.count() == 10 + 5 + 3
    assert append.newer_rows(once, fetched).count() == 0
    assert once.where("city = 'a' and hour(date) = 9").first()["us_aqi"] == 10.0


def test_keep_first_takes_many_copies(spark):
    copies = hours(spark, 0, 4).crossJoin(spark.range(500)).withColumn("us_aqi", F.col("id") * 1.0)
    kept = append.keep_first(copies, "id")
    assert kept.count() == 4 and kept.select(F.max("us_aqi")).first()[0] == 0.0


def test_chunk_with_history_equals_whole_series(spark):
    whole = hours(spark, 0, 200)
    chunk, stored = whole.where("date >= '2024-01-07'"), whole.where("date < '2024-01-08'")
    got = append.chunk_features(chunk, history=stored).orderBy("date").toPandas()
    want = windows.station_features(whole).where("date >= '2024-01-07'").orderBy("date").toPandas()
    pd.testing.assert_frame_equal(got, want[got.columns])
    assert append.chunk_features(chunk).count() == chunk.count() - 48


def test_stream_takes_duplicates_late_rows_and_replays(spark, tmp_path):
    series = Series()
    store = FeatureStore(spark, f"{tmp_path}/store", series)
    store.seed(hours(spark, 0, 100))
    drops, progress = f"{tmp_path}/drops", f"{tmp_path}/progress"

    def run(df):
        df.coalesce(1).write.mode("append").parquet(drops)
        append_stream(store, drops, progress, once=True).awaitTermination()
        return store.read().count()

    assert run(hours(spark, 100, 10)) == 62
    twice = hours(spark, 103, 12).unionByName(hours(spark, 103, 12)).unionByName(hours(spark, 90, 5, value=9.0))
    assert run(twice) == 67
    append_stream(store, drops, progress, once=True).awaitTermination()
    assert store.read().count() == 67
    assert run(hours(spark, 0, 60, "b")) == 67 + 12

    before = store.read().orderBy("city", "date").toPandas()
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "store" / "rows").iterdir() if "=" in p.name)
    store.append(hours(spark, 0, 60, "b"), last)
    after = store.read().orderBy("city", "date").toPandas()
    pd.testing.assert_frame_equal(before, after)
    whole = windows.station_features(hours(spark, 0, 115), series).orderBy("date").toPandas()
    mine = after[after.city == "a"].reset_index(drop=True)
    pd.testing.assert_frame_equal(mine[whole.columns], whole)


def test_watermark_drops_what_is_too_late(spark, tmp_path):
    store = FeatureStore(spark, f"{tmp_path}/store")
    store.seed(hours(spark, 0, 100))
    for rows in (hours(spark, 100, 100), hours(spark, 190, 20), hours(spark, 0, 100, "b")):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/drops")
        stream = append_stream(store, f"{tmp_path}/drops", f"{tmp_path}/progress", late="2 days", once=True)
        stream.awaitTermination()
    assert store.read().where("city = 'a'").count() == 162
    assert store.read().where("city = 'b'").count() == 0


def test_csv_keeps_offsets_and_partitions(spark, tmp_path, small):
    days = series_days(spark, small).withColumn("date", F.col("date").cast("timestamp"))
    files.write_csv(days, f"{tmp_path}/days", DAYS)
    back = files.read_csv(spark, f"{tmp_path}/days", RAW_HOURS)
    assert back.exceptAll(days.select(*back.columns)).count() == 0 and back.count() == days.count()
    assert {p.name for p in (tmp_path / "days").glob("city=*")} == {"city=Karachi", "city=Lahore", "city=Islamabad"}

    text = "date,city,random_forest_pred,ridge_pred,svr_pred\n2025-08-25 00:00:00+00:00,Karachi,70.5,66.25,\n"
    (tmp_path / "forecast.csv").write_text(text)
    row = files.read_csv(spark, f"{tmp_path}/forecast.csv", FORECAST).first()
    assert row["ridge_pred"] == 66.25 and row["svr_pred"] is None and row["date"] is not None


def test_payload_files(spark, tmp_path):
    hourly = {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "bad"], "pm10": [1.0, None, 3.0], "ozone": [4.0, 5.0, 6.0]}
    (tmp_path / "a.json").write_text(json.dumps({"hourly": hourly}))
    rows = payloads.read_json_payloads(spark, str(tmp_path), ["pm10", "ozone"]).orderBy("ozone").collect()
    assert [r["pm10"] for r in rows] == [1.0, None, 3.0]
    assert rows[2]["date"] is None and rows[0]["source"].endswith("a.json")

    typed = spark.createDataFrame(
        [("x", 0, 7200, 3600, [1.0, 2.0]), ("empty", 0, 0, 3600, [])],
        "city string, start long, end long, interval long, pm10 array<double>",
    )
    got = payloads.typed_payload_rows(typed, ["pm10"]).orderBy("date").collect()
    assert [(r["city"], r["pm10"]) for r in got] == [("x", 1.0), ("x", 2.0)]


def test_new_station_in_short_drops_gets_its_features(spark, tmp_path):
    """Hours of a station come in drops shorter than any lag, with gaps that are filled forward."""
    series = Series()
    whole = hours(spark, 0, 90).withColumn("pm10", F.when(F.hour("date") % 5 != 0, F.col("pm10")))
    want = windows.station_features(whole, series, nulls="ffill_drop").orderBy("date").toPandas()
    for size in (30, 7):
        store = FeatureStore(spark, f"{tmp_path}/store{size}", series)
        for batch, begin in enumerate(range(0, 90, size)):
            part = whole.where(F.col("date") >= F.lit("2024-01-01") + F.expr(f"INTERVAL {begin} HOURS"))
            part = part.where(F.col("date") < F.lit("2024-01-01") + F.expr(f"INTERVAL {begin + size} HOURS"))
            store.append(part, batch)
            store.append(part.limit(0), batch)  # nothing new changes nothing
        got = store.read().orderBy("date").toPandas()
        assert len(got) == 90 - 48
        pd.testing.assert_frame_equal(got[want.columns], want)
        assert len(list((tmp_path / f"store{size}" / "state").iterdir())) <= 2


def test_writers_keep_rows_without_station_or_time(spark, tmp_path):
    rows = hours(spark, 0, 8).withColumns(
        {
            "city": F.when(F.hour("date") != 3, F.col("city")),
            "date": F.when(F.hour("date") != 5, F.col("date")),
        }
    )
    for folders in (True, False):
        files.write_parquet(rows, f"{tmp_path}/p{folders}", folders=folders)
        back = spark.read.schema(rows.schema).parquet(f"{tmp_path}/p{folders}").select(*rows.columns)
        assert back.count() == 8 and back.exceptAll(rows).count() == 0
    files.write_csv(rows, f"{tmp_path}/c", folders=False)
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").count() == 8


def test_bad_payloads_fail_or_are_listed(spark, tmp_path):
    good = {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "pm10": [1.0, 2.0]}
    texts = {
        "good": json.dumps({"hourly": good}),
        "lacks": json.dumps({"hourly": good}),
        "short": json.dumps({"hourly": {**good, "ozone": [1.0]}}),
        "broken": "{not json",
    }
    df = spark.createDataFrame(list(texts.items()), "city string, payload string")
    rows = payloads.json_payload_rows(df, ["pm10", "ozone"], bad="skip").collect()
    assert sorted((r.city, r.pm10, r.ozone) for r in rows) == [
        ("good", 1.0, None), ("good", 2.0, None), ("lacks", 1.0, None), ("lacks", 2.0, None),
    ]
    rejected = payloads.rejected_payloads(df, ["pm10", "ozone"], "payload").collect()
    assert {(r.city, r.reason) for r in rejected} == {
        ("short", "ozone has another length than the time axis"),
        ("broken", "no readable time axis"),
    }
    with pytest.raises(Exception, match="bad payload"):
        payloads.json_payload_rows(df, ["pm10", "ozone"]).collect()

    typed = spark.createDataFrame(
        [("x", 0, 7200, 3600, [1.0, 2.0]), ("short", 0, 7200, 3600, [1.0]), ("none", None, 7200, 3600, [1.0, 2.0])],
        "city string, start long, end long, interval long, pm10 array<double>",
    )
    assert payloads.typed_payload_rows(typed, ["pm10"], bad="skip").count() == 2
    assert {r.city for r in payloads.rejected_payloads(typed, ["pm10"]).collect()} == {"short", "none"}


def test_files_in_local_time_become_features(spark, tmp_path):
    times = [str(t).replace(" ", "T")[:16] for t in pd.date_range("2024-01-01", periods=60, freq="h")]
    hourly = {"time": times, "pm10": [float(i) for i in range(60)]}
    (tmp_path / "São Paulo.json").write_text(json.dumps({"hourly": hourly}))
    rows = payloads.read_json_payloads(spark, str(tmp_path), ["pm10"], city=r"([^/]+)\.json$", zone="Asia/Karachi")
    first = rows.orderBy("date").first()
    assert first.city == "São Paulo" and str(first.local_date) == "2024-01-01 00:00:00"
    assert rows.where("date = timestamp'2023-12-31 19:00:00'").count() == 1
    local = rows.select(F.col("local_date").alias("date"), F.col("pm10").alias("us_aqi"), "city")
    featured = windows.station_features(local)
    assert featured.orderBy("date").first()["hour"] == 0 and featured.count() == 12


def test_new_stations_are_streamed_to_their_last_day(spark, small):
    from hazecast.plans import QUERIES

    got = QUERIES["streamed_new_stations"].build(spark, small).groupBy("city").agg(F.count("*").alias("rows"), F.max("date").alias("last"))
    whole = series_days(spark, small).groupBy("city").agg((F.count("*") - 48).alias("rows"), F.max("date").cast("timestamp_ntz").alias("last"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_local_times_around_the_clock_change(spark):
    """A repeated hour becomes two instants; one missing its first pass, and any other zone, stays."""
    twice = ["2024-10-27T01:30", "2024-10-27T02:00", "2024-10-27T02:30", "2024-10-27T02:00", "2024-10-27T02:30", "2024-10-27T03:00"]
    skipped = ["2024-03-31T01:00", "2024-03-31T03:00"]
    same = ["2024-06-01T05:00", "2024-06-01T05:00", "bad"]
    made = {"twice": twice, "once": twice[3:], "skipped": skipped, "same": same}
    texts = [(c, json.dumps({"hourly": {"time": t, "pm10": [float(i) for i in range(len(t))]}})) for c, t in made.items()]
    df = spark.createDataFrame(texts, "city string, payload string")
    rows = payloads.json_payload_rows(df, ["pm10"], zone="Europe/Berlin")
    got = {c: [] for c in made}
    for r in rows.selectExpr("city", "date_format(date, 'MM-dd HH:mm') AS date", "date_format(local_date, 'HH:mm') AS own").orderBy("pm10").collect():
        got[r.city].append((r.date, r.own))
    assert [d for d, _ in got["twice"]] == ["10-26 23:30", "10-27 00:00", "10-27 00:30", "10-27 01:00", "10-27 01:30", "10-27 02:00"]
    assert [o for _, o in got["twice"]] == [t[11:] for t in twice]
    assert got["once"] == [("10-27 00:00", "02:00"), ("10-27 00:30", "02:30"), ("10-27 02:00", "03:00")]
    assert got["skipped"] == [("03-31 00:00", "01:00"), ("03-31 01:00", "03:00")]
    assert got["same"] == [("06-01 03:00", "05:00"), ("06-01 03:00", "05:00"), (None, None)]


def test_calendar_of_another_column(spark):
    rows = [(dt.datetime(2024, 1, 1, 22) + dt.timedelta(hours=i), "a", float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "date timestamp, city string, us_aqi double")
    df = df.withColumn("local", F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 5 HOUR"))
    got = windows.station_features(df, Series(), nulls="keep", calendar="local").orderBy("date").collect()
    assert [r.hour for r in got] == [(27 + i) % 24 for i in range(60)]
    assert [r.aqi_lag_24 for r in got] == [None] * 24 + [float(i % 7) for i in range(36)]
