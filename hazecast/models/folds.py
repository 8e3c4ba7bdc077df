"""Chronological blocks, hold-outs and a repeatable random split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.operators.layout import Series, is_laid_out, lift, row_positions

SPLITS = 5


def with_blocks(
    df: DataFrame, series: Series = Series(), splits: int = SPLITS, means: list[str] | None = None
) -> DataFrame:
    """Add ``block`` 0..splits: fold k trains on blocks before k and tests block k.

    Of n rows, each test block takes n // (splits + 1); what is left over goes to block 0.
    A station with fewer rows than blocks has nothing to test and is all block 0.
    """
    placed = row_positions(df, series, means)
    size = F.floor(F.col("_n") / (splits + 1))
    first_test = F.col("_n") - size * splits
    block = F.when((size == 0) | (F.col("_pos") < first_test), F.lit(0)).otherwise(
        F.floor(F.try_divide(F.col("_pos") - first_test, size)) + 1
    )
    placed = placed.withColumn("block", block.cast("int")).drop("_pos", "_n")
    return placed if is_laid_out(df) or means is not None else lift(placed)


def with_holdout(df: DataFrame, share: float = 0.2, series: Series = Series()) -> DataFrame:
    """Add ``is_test``: true on the last ``ceil(share * n)`` rows of a station."""
    placed = row_positions(df, series)
    tests = F.ceil(F.col("_n") * share)
    flagged = placed.withColumn("is_test", F.col("_pos") >= F.col("_n") - tests).drop("_pos", "_n")
    return flagged if is_laid_out(df) else lift(flagged)


def with_random_split(df: DataFrame, share: float = 0.2, seed: int = 42, series: Series = Series()) -> DataFrame:
    """Add ``is_test`` by a hash of station, time and seed: the same rows on every run and layout."""
    buckets = 1_000_000
    text = F.concat_ws("|", F.lit(seed), series.key, series.micros())
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % buckets
    return df.withColumn("is_test", bucket < int(share * buckets))
