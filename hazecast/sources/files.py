"""Readers and writers of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazecast.operators.layout import Series, lay_out, lift
from hazecast.schemas import CV_METRICS
from hazecast.session import new_folder

CSV_TIME = "yyyy-MM-dd HH:mm:ssXXX"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row, which must name the columns of the schema in order.

    Columns of ``partitionBy`` come from the folder names.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss[XXX]").csv(path)


def write_csv(df: DataFrame, path: str, series: Series = Series(), *, folders: bool = True) -> None:
    """Overwrite; rows in station and time order inside each file."""
    writer = _by_station(df, series, folders).mode("overwrite").option("header", True)
    writer.option("timestampFormat", CSV_TIME).csv(path)


def write_parquet(
    df: DataFrame, path: str, series: Series = Series(), *, folders: bool = True, mode: str = "overwrite"
) -> None:
    """Columnar store of the same shape.

    With ``folders`` a filter on the station prunes folders, which suits up to some thousands of
    stations; without, it prunes row groups by their station range.
    """
    _by_station(df, series, folders).mode(mode).parquet(path)


def _by_station(df: DataFrame, series: Series, folders: bool) -> DataFrameWriter:
    """Rows gathered by (station, slot): few files, and no task holds a whole hot station.

    Rows without station or time have no slot; they are stored as well, from where they are.
    """
    loose = df.where(F.col(series.key).isNull() | F.col(series.time).isNull())
    rows = lift(lay_out(df, series)).unionByName(loose).sortWithinPartitions(series.key, series.time)
    return rows.write.partitionBy(series.key) if folders else rows.write


def station_table(df: DataFrame, series: Series = Series()) -> DataFrame:
    """The rows stored once below the shared folder, one folder per station.

    Jobs that each take one station then read that station's rows only.
    """
    path = new_folder(df.sparkSession, "stations")
    write_parquet(df, path, series)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_models(models: DataFrame, path: str) -> None:
    """Coefficient table of a linear or kernel fit, with the feature names it was fitted on."""
    models.write.mode("overwrite").parquet(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON object per station and model, in their folders."""
    metrics.write.mode("overwrite").partitionBy("city", "model").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CV_METRICS).json(path)
