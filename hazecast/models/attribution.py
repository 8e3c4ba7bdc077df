"""Sampled Shapley values for any model that scores a DataFrame, and their ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazecast.operators.layout import Series, lift, row_positions
from hazecast.operators.lookup import lookup
from hazecast.session import stored

Scorer = Callable[[DataFrame], DataFrame]


def drawn_background(
    rows: DataFrame,
    background: DataFrame,
    features: list[str],
    series: Series = Series(),
    *,
    permutations: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Station, time, ``_x`` (a row's features), ``_try`` and ``_base``: for each row and try one
    complete background row, drawn from all of its station's by position; null if it has none.
    """
    key, time = series.key, series.time
    values = F.array(*[F.col(c).cast("double") for c in features])
    complete = lift(row_positions(background.select(key, time, *features).dropna(), series))
    complete = stored(complete.select(key, F.col("_pos").alias("_draw"), values.alias("_base")), "background")
    sizes = complete.groupBy(key).agg(F.count("*").alias("_drawn"))
    tried = lookup(rows.select(key, time, values.alias("_x")), sizes, [key], spread=[time])
    tried = tried.withColumn("_try", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    chance = F.xxhash64(F.lit(seed), key, time, "_try")
    # positions are spread over the whole background: no key of this join is hot
    tried = tried.withColumn("_draw", F.pmod(chance, F.col("_drawn"))).drop("_drawn")
    return tried.join(complete, [key, "_draw"], "left").drop("_draw")


def sampled_shapley(
    rows: DataFrame,
    background: DataFrame,
    features: list[str],
    score: Scorer,
    series: Series = Series(),
    *,
    permutations: int = 20,
    paired: bool = False,
    model: str = "random_forest",
    seed: int = 42,
) -> DataFrame:
    """Mean change of the prediction as each feature joins, over random orders of joining.

    For each row and permutation a background row of the same station is drawn; features turn
    from its values to the explained row's one after another, and every step is scored in one
    batch by ``score``, which adds ``pred``. Order and draw are hashes of station, time and
    seed, so they do not depend on partitioning. The values of a row add up to its prediction
    less the mean prediction of the background rows drawn for it. Rows whose station has no
    background, and incomplete rows, get null values.

    With ``paired``, features join in each order and in its reverse: twice the steps, but effects of
    two features at a time come out without error of the order. ``se`` is the standard error of a
    value over the permutations (pairs of them), null for a single one.
    """
    key, time, p = series.key, series.time, len(features)
    tried = drawn_background(rows, background, features, series, permutations=permutations, seed=seed)
    order = F.array_sort(
        F.array(*[F.struct(F.xxhash64(F.lit(seed), key, time, "_try", F.lit(j)), F.lit(j).alias("j")) for j in range(p)])
    )
    tried = tried.withColumn("_order", F.transform(order, lambda s: s["j"]))
    if paired:
        tried = tried.withColumn("_order", F.explode(F.array("_order", F.reverse("_order"))))

    steps = tried.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(p))))
    joined = F.slice("_order", 1, F.col("_step"))
    steps = steps.withColumn("_joined", F.when(F.col("_step") > 0, joined).otherwise(F.array().cast("array<int>")))
    steps = steps.withColumns(
        {
            c: F.when(F.array_contains("_joined", F.lit(j)), F.col("_x")[j]).otherwise(F.col("_base")[j])
            for j, c in enumerate(features)
        }
    )
    scored = score(steps)
    # step s adds the s-th feature of the order and is what the next feature is compared with
    gains = F.array_compact(
        F.array(
            F.when(F.col("_step") > 0, F.struct(F.get("_order", F.col("_step") - 1).alias("j"), F.col("pred").alias("gain"))),
            F.when(F.col("_step") < p, F.struct(F.get("_order", F.col("_step")).alias("j"), (-F.col("pred")).alias("gain"))),
        )
    )
    names = F.array(*[F.lit(c) for c in features])
    # one gain a try and feature, then moments over the tries
    tries = (
        scored.select(key, time, "_try", "_x", F.explode(gains).alias("_g"))
        .groupBy(key, time, "_try", "_g.j")
        .agg(
            F.when(F.count("_g.gain") == F.count("*"), F.sum("_g.gain") / (2 if paired else 1)).alias("gain"),
            F.first("_x").alias("_x"),
        )
    )
    known = F.count("gain") == F.count("*")
    error = F.when(F.count("*") > 1, F.stddev_samp("gain") / F.sqrt(F.count("*")))
    return (
        tries.groupBy(key, time, "j")
        .agg(
            F.when(known, F.sum("gain") / permutations).alias("phi"),
            F.when(known, error).alias("se"),
            F.first("_x").alias("_x"),
        )
        .select(
            key,
            time,
            F.lit(model).alias("model"),
            F.get(names, F.col("j")).alias("feature"),
            F.get("_x", F.col("j")).alias("value"),
            "phi",
            "se",
        )
    )


def ranked_attribution(phis: DataFrame, key: str = "city") -> DataFrame:
    """Features by mean absolute attribution, largest first."""
    means = phis.groupBy(key, "model", "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    ranked = Window.partitionBy(key, "model").orderBy(F.col("mean_abs_phi").desc(), "feature")
    return means.withColumn("rank", F.row_number().over(ranked))
