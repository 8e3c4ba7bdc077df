"""Random forest and single-tree regression per station with MLlib.

One model is one distributed MLlib job over the rows of its station, so a hot station is spread
over all executors. Models of different stations and folds are independent jobs; ``parallelism``
of them are submitted at a time. The number of jobs grows with stations times folds, which suits
up to some thousands of stations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import quote, unquote

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.models.evaluate import regression_metrics
from hazecast.models.folds import SPLITS, with_blocks
from hazecast.operators.layout import Series
from hazecast.schemas import FEATURES, TARGET
from hazecast.sources.files import station_table

VECTOR = "_features"


# fixed values: the settings of the models that are compared
def random_forest(trees: int = 100, depth: int = 30, seed: int = 42, memory_mb: int = 1024) -> RandomForestRegressor:
    """Forest in which every split may look at every feature.

    ``memory_mb`` bounds the statistics of the nodes split in one pass: deep trees need fewer passes with more.
    """
    return RandomForestRegressor(
        featuresCol=VECTOR,
        predictionCol="pred",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="all",
        maxMemoryInMB=memory_mb,
        seed=seed,
    )


def decision_tree(depth: int = 30, seed: int = 42) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol=VECTOR, predictionCol="pred", maxDepth=depth, seed=seed)


def vectorized(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VECTOR).transform(df)


def stations(df: DataFrame, series: Series = Series()) -> Iterator:
    """Station names, streamed to the driver one partition at a time."""
    return (row[0] for row in df.select(series.key).distinct().toLocalIterator())


def fit_trees(
    df: DataFrame,
    estimator,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    names: Iterable | None = None,
    parallelism: int = 4,
) -> dict:
    """Fitted model of every station on all of its complete rows.

    With many stations pass a table with one folder per station, as
    :func:`hazecast.sources.files.station_table` stores it, so that no job reads the others.
    """
    rows = vectorized(df.select(series.key, *features, F.col(target).alias("label")).dropna(), features)

    def fit(name):
        return name, estimator.fit(rows.where(F.col(series.key) == name))

    with ThreadPool(parallelism) as pool:
        return dict(pool.imap_unordered(fit, names if names is not None else stations(df, series)))


def score_trees(
    df: DataFrame,
    models: dict,
    features: list[str] = FEATURES,
    series: Series = Series(),
    *,
    name: str = "random_forest_pred",
) -> DataFrame:
    """All rows with the prediction of their station's model; null where the row is incomplete or
    the station has no model."""
    complete = reduce(lambda a, c: a & F.col(c).isNotNull(), features, F.lit(True))
    # MLlib refuses nulls in a vector; the filler of incomplete rows never reaches a result
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    known = df.select(
        *df.columns, F.struct(*filled).alias("_f"), complete.alias("_complete")
    )
    assembler = VectorAssembler(inputCols=[f"_f.{c}" for c in features], outputCol=VECTOR)
    known = assembler.transform(known)
    parts = [
        model.transform(known.where(F.col(series.key) == station)) for station, model in models.items()
    ]
    # also the rows without station: they are in no other part
    others = known.where(~F.coalesce(F.col(series.key).isin(list(models)), F.lit(False)))
    scored = reduce(DataFrame.unionByName, parts, others.withColumn("pred", F.lit(None).cast("double")))
    return scored.select(*df.columns, F.when(F.col("_complete"), F.col("pred")).alias(name))


def cross_validated_trees(
    df: DataFrame,
    estimator,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    splits: int = SPLITS,
    model: str = "random_forest",
    parallelism: int = 4,
) -> tuple[dict, DataFrame]:
    """Refitted model of every station, and metrics per (station, model, fold)."""
    complete = df.select(series.key, series.time, *features, target).dropna()
    blocked = station_table(with_blocks(complete, series, splits), series)
    names = list(stations(blocked.where(F.col("block") == splits), series))
    metrics = []
    for fold in range(1, splits + 1):
        fitted = fit_trees(
            blocked.where(F.col("block") < fold), estimator, features, target, series,
            names=names, parallelism=parallelism,
        )
        tests = blocked.where(F.col("block") == fold)
        scored = score_trees(tests, fitted, features, series, name="pred")
        scored = scored.withColumns({"model": F.lit(model), "fold": F.lit(fold)})
        metrics.append(regression_metrics(scored, [series.key, "model", "fold"], target=target))
    final = fit_trees(blocked, estimator, features, target, series, parallelism=parallelism)
    return final, reduce(DataFrame.unionByName, metrics)


def save_trees(models: dict, folder: str) -> None:
    """Store every model below ``folder``; any text is a station name."""
    for station, model in models.items():
        model.write().overwrite().save(f"{folder}/station={quote(str(station), safe='')}")


def load_trees(spark: SparkSession, folder: str, kind: type = RandomForestRegressionModel) -> dict:
    """Models that :func:`save_trees` stored, by station."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    folders = [f.getPath().toString() for f in found]
    return {unquote(f.rpartition("/station=")[2]): kind.load(f) for f in folders}

