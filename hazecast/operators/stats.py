"""Summary statistics an analyst's dashboard shows, for all stations in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.functions.columns import aqi_level
from hazecast.operators.frames import last_rows
from hazecast.operators.layout import Series
from hazecast.operators.lookup import lookup
from hazecast.operators.quantiles import quantiles
from hazecast.schemas import PREDICTIONS, TARGET

BINS = 40
WHISKER = 1.5


def long_form(df: DataFrame, columns: list[str], ids: list[str], name: str = "model", value: str = "pred") -> DataFrame:
    """One row per id and column."""
    return df.unpivot(ids, columns, name, value)


def model_means(df: DataFrame, columns: list[str] = PREDICTIONS, key: str = "city") -> DataFrame:
    """Mean prediction of every model."""
    wide = df.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])
    return wide.unpivot([key], columns, "model", "mean_pred")


def describe(
    df: DataFrame, columns: list[str], by: list[str] | None = None, *, approximate: bool = False
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of every column."""
    by = by or ["city"]
    moments = df.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("m")) for c in columns]))
    moments = moments.select(*by, rows.alias("_row")).select(*by, "_row.column", "_row.m.*")
    quartiles = _quartile_columns(quantiles(df, columns, by, approximate=approximate), [*by, "column"])
    return moments.join(quartiles, [*by, "column"], "left").select(
        *by, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _quartile_columns(long: DataFrame, by: list[str]) -> DataFrame:
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
    )


def histogram(df: DataFrame, column: str = TARGET, bins: int = BINS, key: str = "city") -> DataFrame:
    """Counts in equal-width bins between the extremes of a station; empty bins included.

    A station whose values are all equal has everything in bin 1.
    """
    ranges = df.groupBy(key).agg(
        F.min(column).cast("double").alias("_min"), F.max(column).cast("double").alias("_max")
    )
    ranged = lookup(df.where(F.col(column).isNotNull()).select(key, column), ranges, [key], spread=[column])
    width = (F.col("_max") - F.col("_min")) / bins
    place = F.floor(F.try_divide(F.col(column) - F.col("_min"), width)).cast("int") + 1
    bin_of = F.least(F.lit(bins), F.coalesce(place, F.lit(1)))
    counts = ranged.groupBy(key, bin_of.alias("bin")).agg(F.count("*").alias("rows"))
    grid = ranges.where(F.col("_min").isNotNull()).select(
        key, "_min", width.alias("_width"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    return grid.join(counts, [key, "bin"], "left").select(
        key,
        "bin",
        (F.col("_min") + (F.col("bin") - 1) * F.col("_width")).alias("bin_start"),
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
    )


def box_summary(df: DataFrame, column: str = TARGET, key: str = "city") -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 interquartile ranges, outliers beyond."""
    box = _quartile_columns(quantiles(df, [column], [key]), [key])
    spread = (F.col("q75") - F.col("q25")) * WHISKER
    fences = box.select(
        "*", (F.col("q25") - spread).alias("_low"), (F.col("q75") + spread).alias("_high")
    )
    value = F.col(column)
    inside = value.between(F.col("_low"), F.col("_high"))
    whiskers = (
        lookup(df.where(value.isNotNull()).select(key, column), fences, [key], spread=[column])
        .groupBy(key)
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return box.join(whiskers, key).select(key, "q25", "q50", "q75", "whisker_low", "whisker_high", "outliers")


def correlations(df: DataFrame, columns: list[str], key: str = "city") -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are known.

    Null where it is undefined: fewer than two rows, or a constant column. One aggregation
    computes each unordered pair once; the mirror images are added after it.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    undefined = F.lit(None).cast("double")
    wide = df.groupBy(key).agg(
        *[F.nanvl(F.corr(columns[i], columns[j]), undefined).alias(f"_r_{i}_{j}") for i, j in pairs]
    )

    def entry(x: int, y: int):
        return F.struct(
            F.lit(columns[x]).alias("x"),
            F.lit(columns[y]).alias("y"),
            F.col(f"_r_{min(x, y)}_{max(x, y)}").alias("r"),
        )

    size = range(len(columns))
    cells = F.explode(F.array(*[entry(x, y) for x in size for y in size]))
    return wide.select(key, cells.alias("_cell")).select(key, "_cell.*")


def trend_lines(df: DataFrame, features: list[str], target: str = TARGET, key: str = "city") -> DataFrame:
    """Least-squares line of the target on each feature alone, all features in one pass."""
    wide = df.groupBy(key).agg(
        *[
            F.struct(
                F.regr_slope(target, c).alias("slope"),
                F.regr_intercept(target, c).alias("intercept"),
                F.regr_r2(target, c).alias("r2"),
            ).alias(c)
            for c in features
        ]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("fit")) for c in features]))
    return wide.select(key, rows.alias("_row")).select(key, "_row.feature", "_row.fit.*")


def trend_fitted(
    df: DataFrame, feature: str, target: str = TARGET, series: Series = Series()
) -> DataFrame:
    """Points of a feature-target scatter with the height of the trend line at each."""
    line = trend_lines(df, [feature], target, series.key).drop("feature", "r2")
    points = df.select(series.time, series.key, feature, target)
    return lookup(points, line, [series.key], spread=[series.time]).select(
        series.time,
        series.key,
        feature,
        target,
        (F.col("intercept") + F.col("slope") * F.col(feature)).alias("fitted"),
    )


def latest_cards(df: DataFrame, prediction: str, series: Series = Series(), scale: float = 1.0) -> DataFrame:
    """Newest prediction of every station with its level."""
    latest = last_rows(df.select(series.time, series.key, prediction), 1, series)
    index = F.col(prediction) / scale
    return latest.select(series.time, series.key, index.alias("index"), aqi_level(index).alias("level"))


def distinct_cities(df: DataFrame, key: str = "city") -> DataFrame:
    return df.select(key).distinct()


def sorted_by_date(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Rows in station and date order; Spark range-partitions them over all tasks."""
    return df.orderBy(series.key, series.time)


def preview(df: DataFrame, n: int = 5, series: Series = Series()) -> DataFrame:
    """First ``n`` rows by date; each task keeps only its own first ``n``."""
    return df.orderBy(series.time, series.key).limit(n)
