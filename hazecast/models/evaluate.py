"""Regression metrics, their averages over folds, and the choice of the best model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazecast.schemas import MODELS, TARGET


def regression_metrics(
    df: DataFrame, by: list[str], prediction: str = "pred", target: str = TARGET
) -> DataFrame:
    """RMSE, MAE and R² per group in one aggregation.

    R² of a constant target is 1 for a perfect fit, else 0; it needs two rows.
    """
    known = df.where(F.col(prediction).isNotNull() & F.col(target).isNotNull())
    error = F.col(target) - F.col(prediction)
    sums = known.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(error * error).alias("_sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(target).alias("_var"),
    )
    spread = F.col("_var") * F.col("rows")
    r2 = (
        F.when(F.col("rows") < 2, F.lit(None))
        .when(spread > 0, 1 - F.col("_sse") / spread)
        .when(F.col("_sse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return sums.select(
        *by, "rows", F.sqrt(F.col("_sse") / F.col("rows")).alias("rmse"), "mae", r2.alias("r2")
    )


def cv_average(metrics: DataFrame, by: tuple[str, ...] = ("city", "model")) -> DataFrame:
    """Unweighted mean of the metrics over folds."""
    return metrics.groupBy(*by).agg(
        F.avg("rmse").alias("avg_rmse"), F.avg("mae").alias("avg_mae"), F.avg("r2").alias("avg_r2")
    )


def best_model(metrics: DataFrame, r2: str = "avg_r2", order: list[str] = MODELS, key: str = "city") -> DataFrame:
    """Model of the highest R² of every station; the earlier in ``order`` wins a tie."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    ranked = Window.partitionBy(key).orderBy(F.col(r2).desc_nulls_last(), place)
    return metrics.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")
