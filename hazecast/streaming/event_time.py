"""Feature stream in the event time of each station: late hours of one are taken, however far others are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from hazecast.functions.columns import calendar_columns
from hazecast.operators.frames import CONTEXT_ROWS, last_rows
from hazecast.operators.layout import Series
from hazecast.schemas import CALENDAR, MEMORY, RAW_HOURS, READINGS, TARGET

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MICROS = 1_000_000
WINDOW = 24


def _doubles(names: list[str]) -> str:
    return ", ".join(f"{c} double" for c in names)


class StationHours(StatefulProcessor):
    """Keeps of a station the last 48 rows that were released, and the rows that still wait.

    A row waits until the newest hour of its own station is ``late`` microseconds past it; rows are
    released in time order. A row at or below the newest released hour is refused, of several
    copies of an hour the first by arrival is taken. With ``idle`` milliseconds without
    arrivals, all that waits is released by a timer of the station.
    """

    def __init__(self, late: int, idle: int | None):
        self.late, self.idle = late, idle

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", f"time long, {_doubles(READINGS)}")
        self.mark = handle.getValueState("mark", "mark long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = pd.concat([self._held(), initialState[["time", *READINGS]]]).sort_values("time")
        self._keep(held.tail(CONTEXT_ROWS), int(held["time"].iloc[-1]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows)).sort_values(["time", "modified", "path", "place"])
        mark = self._mark()
        if mark is not None:
            fresh = fresh[fresh["time"] > mark]
        held = pd.concat([self._held(), fresh[["time", *READINGS]]])  # what waits came before what arrives
        held = held.drop_duplicates("time").sort_values("time")
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        if len(held):
            yield from self._released(key, held, mark, int(held["time"].iloc[-1]) - self.late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if len(held):
            yield from self._released(key, held, self._mark(), int(held["time"].iloc[-1]))

    def close(self) -> None:
        pass

    def _held(self) -> pd.DataFrame:
        rows = list(self.rows.get()) if self.rows.exists() else []
        return pd.DataFrame(rows, columns=["time", *READINGS]).astype({"time": "int64", **dict.fromkeys(READINGS, float)})

    def _mark(self) -> int | None:
        return self.mark.get()[0] if self.mark.exists() else None

    def _keep(self, held: pd.DataFrame, mark: int | None) -> None:
        self.rows.put(list(held.astype(object).itertuples(index=False, name=None)))
        if mark is not None:
            self.mark.update((mark,))

    def _released(self, key, held: pd.DataFrame, mark: int | None, until: int) -> Iterator[pd.DataFrame]:
        """Features of the waiting rows up to ``until``; the state afterwards. ``held`` is in time order."""
        ready, waiting = held[held["time"] <= until], held[held["time"] > until]
        known = 0 if mark is None else int((ready["time"] <= mark).sum())
        if len(ready) > known:
            out = ready.assign(**memory(ready[TARGET].to_numpy(float))).iloc[known:]
            out.insert(0, "station", key[0])
            yield out
            mark = int(ready["time"].iloc[-1])
        self._keep(pd.concat([ready.tail(CONTEXT_ROWS), waiting]), mark)


def memory(target: np.ndarray) -> dict[str, np.ndarray]:
    """Lag, rolling and change-rate values of a station's rows in time order; NaN where unknown."""
    n = len(target)

    def back(rows: int) -> np.ndarray:
        return np.concatenate([np.full(min(rows, n), np.nan), target[: max(0, n - rows)]])

    frames = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(WINDOW - 1, np.nan), target]), WINDOW)
    before = back(WINDOW)
    change = np.full(n, np.nan)
    np.divide(target - before, before, out=change, where=before != 0)
    return {
        "aqi_lag_24": before,
        "aqi_lag_48": back(CONTEXT_ROWS),
        "aqi_rolling_24_mean": frames.mean(1),
        "aqi_rolling_24_std": frames.std(1, ddof=1),
        "aqi_change_rate": change,
    }


def feature_stream(
    arriving: DataFrame,
    series: Series = Series(),
    *,
    late_hours: int = 48,
    idle_minutes: float | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Streaming features of raw hours with ``_metadata`` of their files: raw columns, calendar, memory.

    Features equal those of the batch table (null policy ``keep``). NaN counts as null; rows without
    station or time are left out. ``history`` gives stored raw rows to go on from. State is
    48 rows and ``late_hours`` of rows a station; a task holds one station's rows of one batch, so
    long backfills belong into ``FeatureStore.seed``, whose rows are then the history. Needs the
    RocksDB state store, see :func:`follow`.
    """
    key, time = series.key, series.time
    named = [F.col(key).alias("station"), F.unix_micros(F.col(time).cast("timestamp")).alias("time"), *READINGS]
    came = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "row_index")]
    came = [F.unix_micros(came[0]).alias("modified"), came[1].alias("path"), came[2].alias("place")]
    rows = arriving.select(*named, *came).where("station IS NOT NULL AND time IS NOT NULL")
    start = None
    if history is not None:
        tail = last_rows(history.select(key, time, *READINGS).dropna(subset=[key, time]), CONTEXT_ROWS, series)
        start = tail.select(*named).groupBy("station")
    idle = None if idle_minutes is None else int(idle_minutes * 60_000)
    made = rows.groupBy("station").transformWithStateInPandas(
        StationHours(late_hours * 3600 * MICROS, idle),
        f"station string, time long, {_doubles([*READINGS, *MEMORY])}",
        "Append",
        "None" if idle is None else "ProcessingTime",
        initialState=start,
    )
    made = made.withColumnsRenamed({"station": key}).withColumn(time, F.timestamp_micros("time")).withColumns(calendar_columns(time))
    return made.select(time, *READINGS, key, *CALENDAR, *MEMORY)


def follow(
    spark: SparkSession,
    incoming: str,
    target: str,
    checkpoint: str,
    series: Series = Series(),
    *,
    schema: T.StructType = RAW_HOURS,
    files_per_batch: int = 1000,
    once: bool = False,
    every: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Follow a folder of Parquet files with raw hours and append their features to another.

    ``options`` are those of :func:`feature_stream`. ``once`` takes what is there and stops; what
    waits then stays in the state of ``checkpoint`` for the next start.
    """
    if once and options.get("idle_minutes") is not None:
        raise ValueError("timers need a stream that keeps running")
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # a query copies the settings when it starts
    try:
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
        writer = feature_stream(arriving, series, **options).writeStream.format("parquet").option("path", target)
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
    finally:
        spark.conf.set(STORE, before)
