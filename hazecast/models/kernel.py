"""Approximate RBF-kernel regression with an epsilon-insensitive loss, per station and fold.

The kernel is replaced by random Fourier features (Rahimi and Recht, 2007), which turns the fit
into a linear one. The loss is minimised by reweighting: in every round each slot of a station
contributes its weighted sums of products, Spark adds them up per (station, fold), and one small
system per (station, fold) is solved. Approximate by design: it does not equal an exact solver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazecast.models.evaluate import regression_metrics
from hazecast.models.folds import SPLITS, with_blocks
from hazecast.models.linear import REFIT, fit_ridge
from hazecast.operators.layout import SLOT, Series, lay_out
from hazecast.schemas import FEATURES, TARGET
from hazecast.session import settle

# fixed values: the settings of the models that are compared
COST, GAMMA, EPSILON = 100.0, 0.1, 0.1
COMPONENTS = 512
ROUNDS = 10
BATCH_ROWS = 10_000
CLOSEST = 1e-3  # residuals beyond the tube count as at least this large in the weights


def fourier_basis(inputs: int, components: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, np.sqrt(2.0 * gamma), (inputs, components))
    return directions, rng.uniform(0.0, 2.0 * np.pi, components)


def fourier_features(z: np.ndarray, basis: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Feature map, with a last column of ones for the intercept."""
    directions, phases = basis
    waves = np.sqrt(2.0 / len(phases)) * np.cos(z @ directions + phases)
    return np.hstack([waves, np.ones((len(z), 1))])


def _scaled(rows: pd.DataFrame, features: list[str], model) -> np.ndarray:
    x = rows[features].to_numpy(dtype=float)
    return (x - np.asarray(model.means)) / np.asarray(model.scales)


def _batches(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Pieces small enough that their Fourier features fit in memory."""
    return (rows.iloc[at : at + BATCH_ROWS] for at in range(0, len(rows), BATCH_ROWS))


def _per_slot(rows: DataFrame, models: DataFrame, series: Series) -> GroupedData:
    """Model rows of a station, once for each slot it has rows in, grouped by slot."""
    slots = rows.select(F.col(series.key).alias("_station"), F.col(SLOT).alias("_at")).distinct()
    named = models.withColumnRenamed(series.key, "_station")
    return slots.join(named, "_station").groupBy("_station", "_at")


def fit_kernel(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    splits: int = SPLITS,
    cost: float = COST,
    gamma: float = GAMMA,
    epsilon: float = EPSILON,
    components: int = COMPONENTS,
    rounds: int = ROUNDS,
    seed: int = 42,
) -> DataFrame:
    """One row per (station, fold): scaler, basis parameters, weights; fold 0 is the refit."""
    key, size = series.key, components + 1
    # read once per round, so stored first
    complete = settle(lay_out(df.select(key, series.time, *features, target).dropna(), series))
    scalers = fit_ridge(complete, features, target, series, splits=splits)
    models = settle(
        scalers.select(
            key, "fold", "features", "means", "scales",
            F.lit(gamma).alias("gamma"), F.lit(seed).alias("seed"), F.lit(components).alias("components"),
            F.lit(None).cast("array<double>").alias("weights"),
        )
    )
    blocked = settle(with_blocks(complete, series, splits))
    key_field = df.schema[key]
    part_schema = T.StructType(
        [
            key_field,
            T.StructField("fold", T.IntegerType()),
            T.StructField("i", T.IntegerType()),
            T.StructField("sums", T.ArrayType(T.DoubleType())),
        ]
    )
    solved_schema = T.StructType(
        [key_field, T.StructField("fold", T.IntegerType()), T.StructField("weights", T.ArrayType(T.DoubleType()))]
    )

    def partial_sums(rows: pd.DataFrame, folds: pd.DataFrame) -> pd.DataFrame:
        """Upper rows of the weighted Gram matrix of one slot, right-hand side appended."""
        basis = fourier_basis(len(features), components, gamma, seed)
        out = []
        for model in folds.itertuples():
            used = rows if model.fold == REFIT else rows[rows["block"] < model.fold]
            if used.empty:
                continue
            gram, right = np.zeros((size, size)), np.zeros(size)
            for part in _batches(used):
                waves = fourier_features(_scaled(part, features, model), basis)
                y = part[target].to_numpy(dtype=float)
                if model.weights is None:
                    weight, goal = np.full(len(y), cost), y
                else:
                    residual = y - waves @ np.asarray(model.weights)
                    beyond = np.abs(residual) - epsilon
                    weight = np.where(beyond > 0, cost / np.maximum(beyond, CLOSEST), 0.0)
                    goal = y - np.sign(residual) * epsilon
                gram += waves.T @ (waves * weight[:, None])
                right += waves.T @ (weight * goal)
            for i in range(size):
                out.append((model.fold, i, np.append(gram[i, i:], right[i])))
        frame = pd.DataFrame(out, columns=["fold", "i", "sums"])
        frame.insert(0, key, rows[key].iloc[0] if len(rows) else None)
        return frame

    def solve(cells: pd.DataFrame) -> pd.DataFrame:
        system = np.zeros((size, size + 1))
        i, at = cells["i"].to_numpy(), cells["at"].to_numpy()
        system[i, i + at] = cells["total"].to_numpy()
        gram = np.triu(system[:, :size])
        gram = gram + np.triu(gram, 1).T
        penalty = np.ones(size)
        penalty[-1] = 1e-9  # the intercept is free
        weights = np.linalg.solve(gram + np.diag(penalty), system[:, size])
        return pd.DataFrame(
            {key: [cells[key].iloc[0]], "fold": [cells["fold"].iloc[0]], "weights": [weights]}
        )

    for _ in range(rounds):
        parts = (
            blocked.groupBy(key, SLOT)
            .cogroup(_per_slot(blocked, models, series))
            .applyInPandas(partial_sums, part_schema)
        )
        cells = (
            parts.select(key, "fold", "i", F.posexplode("sums").alias("at", "v"))
            .groupBy(key, "fold", "i", "at")
            .agg(F.sum("v").alias("total"))
        )
        # a fixed number of cells per (station, fold), whatever its number of rows
        weights = cells.groupBy(key, "fold").applyInPandas(solve, solved_schema)
        models = settle(models.drop("weights").join(weights, [key, "fold"]))
    return models


def score_kernel(
    df: DataFrame,
    models: DataFrame,
    features: list[str] = FEATURES,
    series: Series = Series(),
    *,
    on_fold: str | None = None,
    name: str = "svr_pred",
) -> DataFrame:
    """Add the prediction of the station's refitted model, or that of fold ``on_fold`` of a row.

    Slots bound the rows a task holds at once; a missing feature or model gives null.
    """
    key = series.key
    rows = lay_out(df, series)
    wanted = models if on_fold else models.where(F.col("fold") == REFIT)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def predict(part: pd.DataFrame, folds: pd.DataFrame) -> pd.DataFrame:
        part = part.drop(columns=[SLOT])
        predicted = np.full(len(part), np.nan)
        known = part[features].notna().all(axis=1).to_numpy()
        for model in folds.itertuples():
            chosen = known & (part[on_fold] == model.fold).to_numpy() if on_fold else known
            if chosen.any():
                basis = fourier_basis(len(features), model.components, model.gamma, model.seed)
                weights = np.asarray(model.weights)
                predicted[chosen] = np.concatenate(
                    [
                        fourier_features(_scaled(rows, features, model), basis) @ weights
                        for rows in _batches(part[chosen])
                    ]
                )
        part[name] = pd.array(predicted, dtype="Float64")
        return part

    scored = (
        rows.groupBy(key, SLOT)
        .cogroup(_per_slot(rows, wanted, series))
        .applyInPandas(predict, schema)
    )
    return scored.withColumn(name, F.nanvl(name, F.lit(None).cast("double")))


def cross_validated_kernel(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    splits: int = SPLITS,
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """Model table and metrics per (station, model, fold)."""
    models = fit_kernel(df, features, target, series, splits=splits, **settings)
    complete = df.select(series.key, series.time, *features, target).dropna()
    tests = with_blocks(complete, series, splits).where(F.col("block") > 0)
    scored = score_kernel(tests, models, features, series, on_fold="block", name="pred")
    scored = scored.withColumns({"model": F.lit("svr"), "fold": F.col("block")})
    return models, regression_metrics(scored, [series.key, "model", "fold"], target=target)
