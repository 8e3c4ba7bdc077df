"""Last rows of a station, trailing spans, and the forecast frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazecast.functions.columns import calendar_columns
from hazecast.operators.layout import BEGIN, NOW, Series
from hazecast.operators.lookup import lookup
from hazecast.operators.windows import memory_columns
from hazecast.schemas import MEMORY, POLLUTANTS, TARGET

HISTORY, FORECAST = 0, 1
CONTEXT_ROWS, HORIZON_ROWS = 48, 72


def last_rows(df: DataFrame, n: int, series: Series = Series()) -> DataFrame:
    """Last ``n`` rows of every station.

    Spark limits each station to ``n`` rows inside every map task before the shuffle, so a hot
    station sends a bounded number of rows on.
    """
    if n == 1:
        return _last_row(df, series)
    rank = F.row_number().over(series.in_key(reverse=True))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _last_row(df: DataFrame, series: Series) -> DataFrame:
    rest = [c for c in df.columns if c != series.key]
    return (
        df.groupBy(series.key)
        .agg(*[F.max_by(c, series.time).alias(c) for c in rest])
        .select(*df.columns)
    )


def trailing(df: DataFrame, span: str = "3 days", series: Series = Series()) -> DataFrame:
    """Rows no older than ``span`` before the last row of their station, bound included."""
    latest = df.groupBy(series.key).agg(F.max(series.time).alias("_latest"))
    joined = lookup(df, latest, [series.key], how="inner", spread=[series.time])
    return joined.where(F.col(series.time) >= F.col("_latest") - F.expr(f"INTERVAL {span}")).drop("_latest")


def segmented(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and forecast under each other; columns one side lacks are null.

    The two may overlap in time, so the order of rows is (segment, date), not date.
    """
    return history.withColumn("segment", F.lit(HISTORY)).unionByName(
        forecast.withColumn("segment", F.lit(FORECAST)), allowMissingColumns=True
    )


def forecast_frame(
    history: DataFrame, forecast: DataFrame, series: Series = Series(), target: str = TARGET, horizon: int = HORIZON_ROWS
) -> DataFrame:
    """Feature rows of the last ``horizon`` forecast hours, built on the last 48 history rows of each station.

    A station holds at most 48 + its horizon rows here, so one window per station is enough.
    """
    context = last_rows(history.select(series.time, target, series.key), CONTEXT_ROWS, series)
    ahead = forecast.select(series.time, *POLLUTANTS, series.key)
    rows = segmented(context, ahead)
    order = [F.col("segment"), F.col(series.time)]
    along = Window.partitionBy(series.key).orderBy(*order)
    against = Window.partitionBy(series.key).orderBy(*[c.desc() for c in order])

    rows = rows.withColumns({name: make(along) for name, make in memory_columns(target).items()})
    rows = rows.withColumns(calendar_columns(series.time))
    filled = [c for c in rows.columns if c not in (series.key, series.time, "segment")]
    rows = rows.withColumns({c: _last_known(c, along) for c in filled})
    rows = rows.withColumns({c: _last_known(c, against) for c in filled})
    rows = rows.withColumn("_rank", F.row_number().over(against)).where(F.col("_rank") <= horizon)
    return rows.select(
        series.time, target, *POLLUTANTS, series.key, *calendar_columns(), *MEMORY
    )


def _last_known(column: str, window) -> Column:
    return F.last(column, True).over(window.rowsBetween(BEGIN, NOW))
