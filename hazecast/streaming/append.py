"""Continuous append of arriving hours to a feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from hazecast.operators.append import chunk_features, keep_first, newer_rows
from hazecast.operators.frames import CONTEXT_ROWS, last_rows
from hazecast.operators.layout import Series
from hazecast.operators.windows import forward_fill
from hazecast.schemas import RAW_HOURS, READINGS

SEED_BATCH = -1
ARRIVAL = "_arrival"
CARRY = "_carry"


class FeatureStore:
    """Parquet folders ``rows/batch=N`` with the features and ``state/batch=N`` with what the next
    batch needs: the last 48 raw rows of every station as of batch N, whether or not they gave
    features yet, and its newest filled row, from which a forward fill goes on.

    A batch overwrites its own folders and reads only the newest state before it, so a replayed
    batch, even one lost half-way, leaves the same store. No batch reads the whole store; only
    the last two states are kept.
    """

    def __init__(self, spark: SparkSession, path: str, series: Series = Series()):
        self.spark, self.series = spark, series
        self.rows, self.state = f"{path}/rows", f"{path}/state"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.rows).drop("batch")

    def seed(self, raw: DataFrame) -> None:
        """Start from raw hours at hand: their features and state are computed in one batch."""
        self.append(raw, SEED_BATCH)

    def append(self, arrived: DataFrame, batch: int) -> None:
        """Add the features of the arrived raw hours that are newer than the stored ones."""
        raw = [c for c in arrived.columns if c != ARRIVAL]
        latest = max((n for n in self._batches() if n < batch), default=None)
        state = None if latest is None else self.spark.read.parquet(f"{self.state}/batch={latest}")
        tail = arrived.select(raw).limit(0) if state is None else state.where(~F.col(CARRY)).select(raw)
        fresh = newer_rows(tail, arrived, self.series)
        if ARRIVAL in arrived.columns:
            fresh = keep_first(fresh, ARRIVAL, self.series)
        fresh = fresh.select(raw)
        featured = chunk_features(fresh, self.series, nulls="keep", history=tail)
        carry = featured.limit(0) if state is None else state.where(CARRY).select(featured.columns)
        carried = carry.withColumn(CARRY, F.lit(True)).unionByName(featured.withColumn(CARRY, F.lit(False)))
        values = [c for c in featured.columns if c not in (self.series.key, self.series.time)]
        filled = forward_fill(carried, values, self.series).persist()
        try:
            if filled.where(~F.col(CARRY)).isEmpty():
                return
            new = filled.where(~F.col(CARRY)).drop(CARRY)
            new.dropna().write.mode("overwrite").parquet(f"{self.rows}/batch={batch}")
            newest = last_rows(filled.drop(CARRY), 1, self.series).withColumn(CARRY, F.lit(True))
            behind = last_rows(tail.unionByName(fresh), CONTEXT_ROWS, self.series).withColumn(CARRY, F.lit(False))
            both = newest.unionByName(behind, allowMissingColumns=True)
            both.write.mode("overwrite").parquet(f"{self.state}/batch={batch}")
        finally:
            filled.unpersist()
        for old in self._batches():
            if latest is not None and old < latest:
                self._folder(f"{self.state}/batch={old}", lambda files, path: files.delete(path, True))

    def _batches(self) -> list[int]:
        """Numbers of the batches whose state was written to the end."""

        def complete(files, path):
            found = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
            done = [p for p in found if files.exists(self._path(f"{p.toString()}/_SUCCESS"))]
            return [int(p.getName().removeprefix("batch=")) for p in done]

        return self._folder(self.state, complete)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _folder(self, path: str, use):
        folder = self._path(path)
        return use(folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder)


def append_stream(
    store: FeatureStore,
    incoming: str,
    checkpoint: str,
    *,
    schema: T.StructType = RAW_HOURS,
    late: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Follow a folder of Parquet files with raw hours.

    The store itself refuses hours at or below a station's newest one, and takes the first copy
    of an hour by arrival, so no stream state is needed and a station may lag behind the others.
    With ``late``, for instance ``2 days``, a watermark over all stations additionally drops
    rows that far behind the newest hour of any station, and duplicates within that span.
    ``once`` takes what is there and stops.
    """
    series = store.series
    arriving = store.spark.readStream.schema(schema).parquet(incoming)
    arrival = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")
    arriving = arriving.select(series.time, *READINGS, series.key, arrival.alias(ARRIVAL))
    if late:
        arriving = arriving.withWatermark(series.time, late)
        arriving = arriving.dropDuplicatesWithinWatermark([series.key, series.time])
    writer = arriving.writeStream.foreachBatch(lambda df, batch: store.append(df, batch))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 hour")).start()
