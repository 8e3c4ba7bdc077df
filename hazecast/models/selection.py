"""From training rows to the model of choice: three unlike fits, judged on the same folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.models.evaluate import best_model, cv_average, regression_metrics
from hazecast.models.folds import SPLITS, with_blocks
from hazecast.models.forest import REFIT, fit_forest, score_forest
from hazecast.models.kernel import fit_kernel, score_kernel
from hazecast.models.linear import fit_ridge, score_linear
from hazecast.operators.layout import Series, lift
from hazecast.schemas import FEATURES, TARGET
from hazecast.session import settle, stored
from hazecast.sources import files


def fold_predictions(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    splits: int = SPLITS,
    forest: dict | None = None,
    kernel: dict | None = None,
) -> DataFrame:
    """One long table (station, time, fold, model, target, pred): every tested row once a model.

    Each model of fold k has seen the blocks before k only. ``forest`` and ``kernel`` hold settings of those
    fits. Incomplete rows are left out; a station with fewer rows than blocks is never tested.
    """
    key, time = series.key, series.time
    complete = stored(df.select(key, time, *features, target).dropna(), "complete")
    blocked = stored(lift(with_blocks(complete, series, splits)), "blocked")
    tests = blocked.where(F.col("block") > 0)

    later = F.array(*[F.when(F.col("block") < k, F.lit(k)) for k in range(1, splits + 1)])
    training = blocked.withColumn("block", F.explode(F.array_compact(later)))
    pieces = fit_forest(training, features, target, series, by=[key, "block"], **(forest or {}))
    ridge = settle(fit_ridge(complete, features, target, series, splits=splits))
    folds = ridge.where(F.col("fold") != REFIT).withColumnRenamed("fold", "block")
    support = fit_kernel(complete, features, target, series, splits=splits, **(kernel or {}))
    scored = {
        "random_forest": score_forest(tests, pieces, features, series, by=[key, "block"], name="pred"),
        "ridge": score_linear(tests, folds, features, series, on=[key, "block"], name="pred", stored=True),
        "svr": score_kernel(tests, support, features, series, on_fold="block", name="pred"),
    }
    long = [s.select(key, time, F.col("block").alias("fold"), F.lit(model).alias("model"), target, "pred") for model, s in scored.items()]
    return reduce(DataFrame.unionByName, long)


def judged_models(spark: SparkSession, predictions: DataFrame, path: str, series: Series = Series(), target: str = TARGET) -> DataFrame:
    """Averages over folds as the JSON files below ``path`` hold them, with ``chosen``: the station's best model.

    All models and folds are judged in one aggregation; the choice is made from what was read back.
    """
    metrics = regression_metrics(predictions, [series.key, "model", "fold"], target=target)
    files.write_metrics(cv_average(metrics, (series.key, "model")), path)
    read = files.read_metrics(spark, path)
    best = best_model(read, key=series.key).select(F.col(series.key).alias("_k"), F.col("model").alias("_m"))
    same = (F.col(series.key) == F.col("_k")) & (F.col("model") == F.col("_m"))
    return read.join(best, same, "left").withColumn("chosen", F.col("_m").isNotNull()).drop("_k", "_m")
