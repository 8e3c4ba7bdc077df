"""Ridge regression for all stations and all folds from one aggregation, scoring, attribution.

The normal equations need only sums of products. They are taken per (station, block) with
map-side combine, so a hot station costs no more than its share of the scan. Running sums over
the blocks then hold the training sums of every fold, and the last one those of the refit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazecast.models.evaluate import regression_metrics
from hazecast.models.folds import SPLITS, with_blocks
from hazecast.operators.layout import SLOT, Series, is_laid_out, lift
from hazecast.operators.lookup import lookup
from hazecast.schemas import FEATURES, TARGET
from hazecast.session import settle

REFIT = 0  # fold number of the model fitted on all rows
NEGLIGIBLE = 1e-13


def scaler_stats(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Mean and population deviation of every column; a constant column gets deviation 1."""
    spread = {c: F.stddev_pop(c) for c in columns}
    return df.groupBy(*by).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.when(s > 0, s).otherwise(F.lit(1.0)).alias(f"{c}_scale") for c, s in spread.items()],
    )


def standardized(df: DataFrame, stats: DataFrame, columns: list[str], on: list[str], spread: list[str] | None = None) -> DataFrame:
    """Columns scaled by the statistics of their group."""
    scaled = {c: (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_scale") for c in columns}
    return lookup(df, stats, on, spread=spread).select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns]
    )


def block_sums(
    df: DataFrame, features: list[str], target: str, series: Series, splits: int = SPLITS
) -> DataFrame:
    """Per (station, block): rows, sums and sums of products of the centred columns.

    Columns are centred by the station mean first, which keeps the sums well conditioned. With
    many features, raise ``spark.sql.codegen.maxFields`` above the number of sums, so that they
    stay inside whole-stage code.
    """
    columns = [*features, target]
    layout = [SLOT] if is_laid_out(df) else []
    complete = df.select(series.key, series.time, *layout, *columns).dropna()
    blocked = with_blocks(complete, series, splits, means=columns)
    z = [F.col(c) - F.col(f"_mean_{c}") for c in columns]
    blocked = blocked.withColumns({f"_z_{i}": z[i] for i in range(len(columns))})
    k = len(columns)
    sums = [F.sum(f"_z_{i}") for i in range(k)]
    products = [F.sum(F.col(f"_z_{i}") * F.col(f"_z_{j}")) for i in range(k) for j in range(i, k)]
    centres = [F.max(f"_mean_{c}") for c in columns]  # the same on every row of a station
    return blocked.groupBy(series.key, "block").agg(
        F.count("*").alias("rows"),
        F.array(*centres).alias("centres"),
        F.array(*sums).alias("sums"),
        F.array(*products).alias("products"),
    )


def _model_schema(key_field: T.StructField) -> T.StructType:
    values = T.ArrayType(T.DoubleType())
    return T.StructType(
        [
            key_field,
            T.StructField("fold", T.IntegerType()),
            T.StructField("rows", T.LongType()),
            T.StructField("features", T.ArrayType(T.StringType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("coefs", values),
            T.StructField("means", values),
            T.StructField("scales", values),
        ]
    )


def fit_ridge(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    alpha: float = 1.0,
    splits: int = SPLITS,
    scaled: bool = True,
) -> DataFrame:
    """One row per (station, fold) with coefficients, means and scales; fold 0 is the refit.

    Prediction is intercept + sum of coef * (x - mean) / scale.
    """
    sums = block_sums(df, features, target, series, splits)
    key, p = series.key, len(features)
    upper = np.triu_indices(p + 1)

    def solve(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        centre = np.array(blocks["centres"].iloc[0], dtype=float)
        fitted = []
        for fold in range(splits + 1):
            seen = blocks if fold == REFIT else blocks[blocks["block"] < fold]
            n = int(seen["rows"].sum())
            if n == 0:
                continue
            total = np.sum(np.stack(seen["sums"].to_list()), axis=0)
            gram = np.zeros((p + 1, p + 1))
            gram[upper] = np.sum(np.stack(seen["products"].to_list()), axis=0)
            gram = gram + np.triu(gram, 1).T
            offset = total / n
            moments = gram - n * np.outer(offset, offset)
            mean = centre + offset
            scale = np.ones(p)
            if scaled:
                deviation = np.sqrt(np.maximum(np.diag(moments)[:p] / n, 0.0))
                varies = deviation > NEGLIGIBLE * np.maximum(np.abs(mean[:p]), 1.0)
                scale[varies] = deviation[varies]
            normal = moments[:p, :p] / np.outer(scale, scale) + alpha * np.eye(p)
            coefs = np.linalg.solve(normal, moments[:p, p] / scale)
            fitted.append((blocks[key].iloc[0], fold, n, features, mean[p], coefs, mean[:p], scale))
        names = [key, "fold", "rows", "features", "intercept", "coefs", "means", "scales"]
        return pd.DataFrame(fitted, columns=names)

    # at most splits + 1 rows of sums per station
    return sums.groupBy(key).applyInPandas(solve, _model_schema(df.schema[key]))


def coefficient_rows(models: DataFrame, series: Series = Series()) -> DataFrame:
    """Long form: one row per (station, fold, feature)."""
    zipped = F.arrays_zip("features", "coefs", "means", "scales")
    return models.select(series.key, "fold", "intercept", F.explode(zipped).alias("_f")).select(
        series.key,
        "fold",
        F.col("_f.features").alias("feature"),
        F.col("_f.coefs").alias("coef"),
        F.col("_f.means").alias("mean"),
        F.col("_f.scales").alias("scale"),
        "intercept",
    )


def score_linear(
    df: DataFrame,
    models: DataFrame,
    features: list[str] = FEATURES,
    series: Series = Series(),
    *,
    on: list[str] | None = None,
    name: str = "ridge_pred",
    stored: bool = False,
) -> DataFrame:
    """Add the prediction of the station's model; a missing feature or model gives null.

    The features must be those of the fit, in its order; the model table stores them.
    """
    on = on or [series.key]
    parts = models.select(
        *on, "intercept", F.col("coefs").alias("_c"), F.col("means").alias("_m"), F.col("scales").alias("_s")
    ).withColumnRenamed("intercept", "_b")
    joined = lookup(df, parts, on, spread=[series.time], stored=stored)
    prediction = F.col("_b")
    for j, c in enumerate(features):
        prediction = prediction + F.col("_c")[j] * (F.col(c) - F.col("_m")[j]) / F.col("_s")[j]
    return joined.withColumn(name, prediction).drop("_b", "_c", "_m", "_s")


def stored_features(models: DataFrame) -> list[str]:
    """Feature names a model table was fitted on."""
    return list(models.select("features").first()[0])


def cross_validated_ridge(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    alpha: float = 1.0,
    splits: int = SPLITS,
    scaled: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Model table and metrics per (station, model, fold). Reads ``df`` twice: pass a stored table."""
    models = settle(fit_ridge(df, features, target, series, alpha=alpha, splits=splits, scaled=scaled))
    complete = df.select(series.key, series.time, *features, target).dropna()
    tests = lift(with_blocks(complete, series, splits)).where(F.col("block") > 0)
    folds = models.where(F.col("fold") != REFIT).withColumnRenamed("fold", "block")
    scored = score_linear(tests, folds, features, series, on=[series.key, "block"], name="pred", stored=True)
    scored = scored.withColumns({"model": F.lit("ridge"), "fold": F.col("block")})
    return models, regression_metrics(scored, [series.key, "model", "fold"], target=target)


def linear_attribution(
    df: DataFrame,
    models: DataFrame,
    features: list[str] = FEATURES,
    series: Series = Series(),
    *,
    background: DataFrame | None = None,
    model: str = "ridge",
) -> DataFrame:
    """Rows (station, time, model, feature, value, phi): weight times distance from the mean.

    Over the background (the scored rows by default) the values of a row add up to its
    prediction less the mean prediction.
    """
    reference = (df if background is None else background).groupBy(series.key).agg(
        F.array(*[F.avg(c) for c in features]).alias("_mean")
    )
    weights = models.select(series.key, F.col("coefs").alias("_c"), F.col("scales").alias("_s"))
    parts = reference.join(weights, series.key)
    joined = lookup(df.select(series.key, series.time, *features), parts, [series.key], spread=[series.time])
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            (F.col("_c")[j] / F.col("_s")[j] * (F.col(c) - F.col("_mean")[j])).alias("phi"),
        )
        for j, c in enumerate(features)
    ]
    return joined.select(
        series.key, series.time, F.lit(model).alias("model"), F.explode(F.array(*cells)).alias("_cell")
    ).select(series.key, series.time, "model", "_cell.*")
