"""Predictions of every available model side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.models.forest import score_forest
from hazecast.models.kernel import score_kernel
from hazecast.models.linear import REFIT, score_linear
from hazecast.models.trees import score_trees
from hazecast.operators.frames import last_rows
from hazecast.operators.layout import Series
from hazecast.schemas import FEATURES, PREDICTIONS


def forecasts(
    frame: DataFrame,
    *,
    ridge: DataFrame | None = None,
    forest: DataFrame | dict | None = None,
    kernel: DataFrame | None = None,
    features: list[str] = FEATURES,
    series: Series = Series(),
) -> DataFrame:
    """Date, station and one prediction column per given model; the others are left out.

    ``forest``: pieces of :mod:`hazecast.models.forest`, or MLlib models by station.
    """
    scored = frame
    if isinstance(forest, dict):
        scored = score_trees(scored, forest, features, series)
    elif forest is not None:
        scored = score_forest(scored, forest, features, series)
    if ridge is not None:
        refit = ridge.where(F.col("fold") == REFIT)
        scored = score_linear(scored, refit, features, series)
    if kernel is not None:
        scored = score_kernel(scored, kernel, features, series)
    made = [c for c in PREDICTIONS if c in scored.columns]
    return scored.select(series.time, series.key, *made)


def latest_forecast(features_table: DataFrame, series: Series = Series(), **models) -> DataFrame:
    """Predictions for the newest feature row of every station."""
    return forecasts(last_rows(features_table, 1, series), series=series, **models)
