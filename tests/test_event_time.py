"""Feature stream in event time per station."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest

from hazecast.operators.layout import Series
from hazecast.operators.windows import station_features
from hazecast.schemas import MEMORY, RAW_HOURS, READINGS, TARGET
from hazecast.streaming.event_time import StationHours, follow

HOUR = 3600 * 1_000_000


class Held:
    """State of one station in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    put = update = lambda self, value: setattr(self, "value", value)


class Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, Held())

    getValueState = getListState

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def getCurrentProcessingTimeInMs(self):
        return 1000


def station(late=24, idle=None):
    own = StationHours(late * HOUR, idle)
    own.init(Handle())
    return own


def arrivals(rows, place=0):
    """Rows (hour, target) of one batch, in order of arrival."""
    made = [(h * HOUR, *[v] * len(READINGS), 0, "p", place + i) for i, (h, v) in enumerate(rows)]
    return pd.DataFrame(made, columns=["time", *READINGS, "modified", "path", "place"])


def send(own, rows):
    out = list(own.handleInputRows(("a",), iter([arrivals(rows[:3]), arrivals(rows[3:], 3)]), Clock()))
    return [(int(r.time // HOUR), getattr(r, TARGET)) for part in out for r in part.itertuples()]


def test_rows_wait_and_late_ones_are_refused():
    own = station(late=2)
    assert send(own, [(0, 1.0), (2, 2.0), (1, 3.0)]) == [(0, 1.0)]
    assert send(own, [(0, 9.0), (1, 9.0)]) == []  # released already; a copy of a row that waits
    assert send(own, [(3, 4.0), (5, 5.0), (3, 9.0), (4, 6.0)]) == [(1, 3.0), (2, 2.0), (3, 4.0)]
    assert send(own, [(2, 9.0)]) == []
    assert send(own, [(7, 7.0)]) == [(4, 6.0), (5, 5.0)]


@pytest.mark.parametrize("seed", range(4))
def test_any_order_within_the_bound_gives_the_batch_values(seed):
    draw = np.random.default_rng(seed)
    hours = np.flatnonzero(draw.random(300) < 0.8)
    values = {int(h): float(draw.integers(0, 4)) if draw.random() < 0.95 else np.nan for h in hours}
    order = sorted(values, key=lambda h: h + draw.integers(0, 20))
    own, out = station(late=20), []
    for begin in range(0, len(order), 17):
        rows = [(h, values[h]) for h in order[begin : begin + 17]]
        rows += [(h, 99.0) for h in order[max(0, begin - 9) : begin : 3]]  # repeated later, changed
        out += list(own.handleInputRows(("a",), iter([arrivals(rows)]), Clock()))
        assert len(own._held()) <= 48 + 20 + 1
    out += list(own.handleExpiredTimer(("a",), Clock(), None))
    got = pd.concat(out)
    assert got["time"].tolist() == [h * HOUR for h in sorted(values)]
    y = pd.Series([values[h] for h in sorted(values)])
    frame = y.rolling(24, min_periods=24)
    change = (y - y.shift(24)) / y.shift(24).replace(0, np.nan)
    want = [y.shift(24), y.shift(48), frame.mean(), frame.std(), change]
    for name, column in zip(MEMORY, want, strict=True):
        assert np.allclose(got[name], column, equal_nan=True), name


def test_timer_moves_with_every_arrival():
    own = station(idle=500)
    send(own, [(0, 1.0)])
    send(own, [(1, 1.0)])
    assert own.handle.timers == [1500]
    (rest,) = own.handleExpiredTimer(("a",), Clock(), None)
    assert len(rest) == 2 and not list(own.handleExpiredTimer(("a",), Clock(), None))
    assert send(own, [(1, 2.0), (2, 2.0)]) == []


def test_history_comes_first():
    own = station(late=0)
    own.handleInitialState(("a",), arrivals([(h, float(h)) for h in range(30)]), Clock())
    own.handleInitialState(("a",), arrivals([(h, float(h)) for h in range(30, 60)]), Clock())
    (out,) = own.handleInputRows(("a",), iter([arrivals([(59, 0.0), (60, 5.0)])]), Clock())
    assert out["time"].tolist() == [60 * HOUR]
    assert out["aqi_lag_24"].tolist() == [36.0] and out["aqi_lag_48"].tolist() == [12.0]


def test_stream_with_history_and_timer(spark, tmp_path):
    """All rows come out in the end: the timer releases what waits. Null stations are left out."""
    start = dt.datetime(2024, 3, 1)
    rows = [(start + dt.timedelta(hours=h), *[float((h * k) % 11) for k in range(1, 10)], c) for c in "ab" for h in range(130)]
    raw = spark.createDataFrame(rows, RAW_HOURS)
    old, new = raw.where("date < '2024-03-04'"), raw.where("date >= '2024-03-04'")
    odd = spark.createDataFrame([(start, *[1.0] * 9, None), (None, *[1.0] * 9, "a")], RAW_HOURS)
    drops, made = str(tmp_path / "drops"), str(tmp_path / "rows")
    new.union(odd).repartition(3).write.parquet(drops)
    with pytest.raises(ValueError, match="keeps running"):
        follow(spark, drops, made, "-", once=True, idle_minutes=1)
    stream = follow(spark, drops, made, str(tmp_path / "progress"), history=old, idle_minutes=0.02, every="1 second")
    want = station_features(raw, Series(), nulls="keep").where("date >= '2024-03-04'")
    try:
        until = time.time() + 60
        while time.time() < until and stream.isActive:
            time.sleep(1)
            got = spark.read.schema(want.schema).parquet(made) if (tmp_path / "rows" / "_spark_metadata").exists() else None
            if got is not None and got.count() == want.count():
                break
    finally:
        stream.stop()
    assert stream.exception() is None
    key = ["city", "date"]
    a, b = (d.toPandas().sort_values(key).reset_index(drop=True) for d in (got, want.select(*got.columns)))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
