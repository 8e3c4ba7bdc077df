"""Exact interpolated quantiles per group, without gathering a large group in one task.

A first pass counts every group. Groups of at most ``accuracy`` rows are dealt by their key and go into the
built-in exact aggregate. Of each larger one, whose number is a small part of the rows, a mergeable sketch
gives, for every wanted quantile, a narrow band of values certain to contain it. Another pass counts the
values below each band, and collects, as (value, count) pairs, only the values inside. These are cut into
ranges of even size, and the quantile is read off the running counts of the range that holds its rank, so
that no task sees a whole band. A column that is short in a large group takes the exact aggregate as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazecast.operators.layout import BEGIN, NOW
from hazecast.operators.lookup import lookup
from hazecast.session import settle, stored

QUARTILES = (0.25, 0.5, 0.75)


def quantiles(
    df: DataFrame,
    columns: list[str],
    by: list[str],
    probabilities: tuple[float, ...] = QUARTILES,
    *,
    accuracy: int = 10_000,
    approximate: bool = False,
    spread: list[str] | None = None,
) -> DataFrame:
    """Rows (by..., column, q, value), linearly interpolated between order statistics.

    Reads ``df`` twice, and three times more if it has large groups: pass a stored table.
    """
    if approximate:
        return _approximate(df, columns, by, probabilities, accuracy)
    crowded = reduce(lambda a, b: a | b, [F.count(c) > accuracy for c in columns])
    large = settle(df.groupBy(*by).agg(crowded.alias("_large")).where("_large"))
    marked = lookup(df.select(*by, *columns, *_extra(spread, by, columns)), large, by, spread=spread, stored=True)
    # rows without key belong to no group
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    small = marked.where(F.col("_large").isNull() & keyed).repartition(*by).groupBy(*by)
    exact = small.agg(*[F.percentile(c, list(probabilities)).alias(f"_exact_{i}") for i, c in enumerate(columns)])
    found = _long(exact, by, columns, probabilities, lambda i, j: {"value": F.col(f"_exact_{i}")[j]}).where(F.col("value").isNotNull())
    if large.isEmpty():
        return found
    return found.unionByName(_banded(marked.where("_large").drop("_large"), columns, by, probabilities, accuracy, spread))


def _banded(df, columns, by, probabilities, accuracy, spread) -> DataFrame:
    """Quantiles of groups that are too large for one task, from a band around each."""
    key = [*by, "column"]
    bands = settle(_bands(df, columns, by, probabilities, accuracy))
    kept = [*by, *_extra(spread, by, columns)]
    values = df.select(*kept, *[F.col(c).cast("double") for c in columns]).unpivot(kept, columns, "column", "value")
    banded = lookup(values.where(F.col("value").isNotNull()), bands, key, how="inner", spread=spread, stored=True)
    below = [F.count_if(F.col("value") < F.col(f"_lo_{j}")).alias(f"_below_{j}") for j in range(len(probabilities))]
    deep = banded.where(~F.col("_short"))
    passed = settle(deep.groupBy(*key).agg(F.count("*").alias("n"), *below))
    each = [F.struct(F.lit(p).alias("q"), F.col(f"_below_{j}").alias("below")) for j, p in enumerate(probabilities)]
    ranks = passed.select(*key, "n", F.explode(F.array(*each)).alias("_rank")).select(*key, "n", "_rank.*")
    inside = [F.col("value").between(F.col(f"_lo_{j}"), F.col(f"_hi_{j}")) for j in range(len(probabilities))]
    hits = F.array_compact(F.array(*[F.when(w, F.lit(p)) for w, p in zip(inside, probabilities, strict=True)]))
    hit = deep.where(reduce(lambda a, b: a | b, inside)).select(*key, "value", F.explode(hits).alias("q"))
    counted = hit.groupBy(*key, "q", "value").agg(F.count("*").alias("copies"))
    picked = _at_ranks(counted, ranks, [*key, "q"])
    position = (F.col("n") - 1) * F.col("q")
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * (position - F.floor(position))
    found = picked.select(*key, "q", between.alias("value"))
    if bands.where("_short").isEmpty():
        return found
    exact = banded.where("_short").groupBy(*key).agg(F.percentile("value", list(probabilities)).alias("_exact"))
    each = [F.struct(F.lit(p).alias("q"), F.col("_exact")[j].alias("value")) for j, p in enumerate(probabilities)]
    return found.unionByName(exact.select(*key, F.explode(F.array(*each)).alias("_row")).select(*key, "_row.*"))


def _at_ranks(counted: DataFrame, ranks: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n, lower, upper): the values on either side of the wanted rank of every band.

    Bands are cut by value into ranges of even size and counted per range; only the ranges that hold a wanted
    rank are ranked value by value.
    """
    ranged = counted.repartitionByRange(*key, "value").withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "bands")
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(BEGIN, -1)
    ranges = ranged.groupBy(*key, "_range").agg(F.sum("copies").alias("_own")).join(ranks, key)
    ranges = ranges.withColumn("_start", F.col("below") + F.coalesce(F.sum("_own").over(before), F.lit(0)))
    position = (F.col("n") - 1) * F.col("q")
    sides = {"lower": F.floor(position), "upper": F.ceil(position)}
    holds = [(F.col("_start") <= r) & (r < F.col("_start") + F.col("_own")) for r in sides.values()]
    wanted = ranges.where(holds[0] | holds[1]).select(*key, "_range", "_start", "n")
    running = Window.partitionBy(*key, "_range").orderBy("value").rowsBetween(BEGIN, NOW)
    placed = ranged.join(wanted, [*key, "_range"]).withColumn("upto", F.col("_start") + F.sum("copies").over(running))
    found = [F.min(F.when(F.col("upto") > r, F.col("value"))).alias(name) for name, r in sides.items()]
    return placed.groupBy(*key).agg(F.first("n").alias("n"), *found)


def _extra(spread: list[str] | None, by: list[str], columns: list[str]) -> list[str]:
    return [c for c in spread or [] if c not in by and c not in columns]


def _bands(df, columns, by, probabilities, accuracy) -> DataFrame:
    """Per group and column, a row each, whether it is short, and the bounds of the band of every quantile.

    The sketch errs by at most one part in ``accuracy`` of the rows; the band adds three more
    on either side.
    """
    margin = 4.0 / accuracy
    wanted = [max(0.0, p - margin) for p in probabilities] + [min(1.0, p + margin) for p in probabilities]
    sketches = df.groupBy(*by).agg(
        *[F.percentile_approx(c, wanted, accuracy).alias(f"_s_{i}") for i, c in enumerate(columns)],
        *[F.count(c).alias(f"_cnt_{i}") for i, c in enumerate(columns)],
    )
    k = len(probabilities)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"_cnt_{i}") <= accuracy).alias("_short"),
            *[F.col(f"_s_{i}")[j].cast("double").alias(f"_lo_{j}") for j in range(k)],
            *[F.col(f"_s_{i}")[k + j].cast("double").alias(f"_hi_{j}") for j in range(k)],
        )
        for i, c in enumerate(columns)
    ]
    return sketches.select(*by, F.explode(F.array(*rows)).alias("_row")).select(*by, "_row.*")


def _long(wide, by, columns, probabilities, parts) -> DataFrame:
    """One row per group, column and quantile out of a wide table."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(p).alias("q"),
            *[value.alias(name) for name, value in parts(i, j).items()],
        )
        for i, c in enumerate(columns)
        for j, p in enumerate(probabilities)
    ]
    return wide.select(*by, F.explode(F.array(*rows)).alias("_row")).select(*by, "_row.*")


def _approximate(df, columns, by, probabilities, accuracy) -> DataFrame:
    sketches = df.groupBy(*by).agg(
        *[
            F.percentile_approx(c, list(probabilities), accuracy).alias(f"_s_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return _long(
        sketches, by, columns, probabilities, lambda i, j: {"value": F.col(f"_s_{i}")[j].cast("double")}
    )
