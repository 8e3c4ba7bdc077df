"""Deduplication and incremental append of new hours to stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazecast.operators.frames import last_rows
from hazecast.operators.layout import Series
from hazecast.operators.lookup import lookup
from hazecast.operators.windows import station_features
from hazecast.schemas import TARGET


def keep_first(df: DataFrame, sequence: str, series: Series = Series()) -> DataFrame:
    """One row per (station, time): the one that came in first by ``sequence``.

    Spark keeps one row per group inside each map task before the shuffle, so many copies of
    one hour cost no more than one.
    """
    copies = Window.partitionBy(series.key, series.time).orderBy(sequence)
    return df.withColumn("_rank", F.row_number().over(copies)).where(F.col("_rank") == 1).drop("_rank")


def merge_keep_existing(existing: DataFrame, incoming: DataFrame, series: Series = Series()) -> DataFrame:
    """Union in which a stored row wins over an incoming row of the same hour."""
    both = existing.withColumn("_source", F.lit(0)).unionByName(
        incoming.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return keep_first(both, "_source", series).drop("_source")


def high_water(existing: DataFrame, series: Series = Series()) -> DataFrame:
    """Newest stored time of every station."""
    return existing.groupBy(series.key).agg(F.max(series.time).alias("_mark"))


def newer_rows(existing: DataFrame, incoming: DataFrame, series: Series = Series()) -> DataFrame:
    """Incoming rows past the newest stored row of their station; late corrections are ignored."""
    marked = lookup(incoming, high_water(existing, series), [series.key], spread=[series.time])
    return marked.where(F.col("_mark").isNull() | (F.col(series.time) > F.col("_mark"))).drop("_mark")


def appended(existing: DataFrame, incoming: DataFrame, series: Series = Series()) -> DataFrame:
    """Stored rows followed by the incoming rows newer than them."""
    return existing.unionByName(newer_rows(existing, incoming, series))


def chunk_features(
    chunk: DataFrame,
    series: Series = Series(),
    *,
    nulls: str = "ffill_drop",
    history: DataFrame | None = None,
    target: str = TARGET,
) -> DataFrame:
    """Features of freshly fetched rows.

    From the chunk alone the first 48 rows of a station are lost to missing lags. With
    ``history`` the last 48 stored rows before the chunk come first, and only chunk rows are
    returned.
    """
    if history is None:
        return station_features(chunk, series, target=target, nulls=nulls)
    begins = chunk.groupBy(series.key).agg(F.min(series.time).alias("_begin"))
    stored = lookup(history, begins, [series.key], how="inner", spread=[series.time])
    stored = stored.where(F.col(series.time) < F.col("_begin")).drop("_begin")
    context = last_rows(stored.select(*chunk.columns), 48, series)
    both = context.withColumn("_context", F.lit(True)).unionByName(
        chunk.withColumn("_context", F.lit(False))
    )
    featured = station_features(both, series, target=target, nulls=nulls)
    return featured.where(~F.col("_context")).drop("_context")
