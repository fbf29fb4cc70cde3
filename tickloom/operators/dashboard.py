"""Data sets behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.chunks import attach_per_symbol

OUTLIER_DEVIATIONS = 3.0


def scatter_points(
    predictions: DataFrame,
    actual: str = "current_price",
    predicted: str = "previous_day_predicted_price",
) -> DataFrame:
    """Forecast against actual, one point per row that has both."""
    return predictions.select(
        "symbol", "date", F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).na.drop(subset=["actual", "predicted"])


def residual_outliers(points: DataFrame, deviations: float = OUTLIER_DEVIATIONS) -> DataFrame:
    """Points whose residual is beyond so many sample deviations of its symbol."""
    residuals = points.withColumn("residual", F.col("actual") - F.col("predicted"))
    spread = residuals.groupBy("symbol").agg(
        F.stddev_samp("residual").alias("residual_deviation")
    )
    joined = attach_per_symbol(residuals, spread)
    return joined.where(
        F.abs("residual") > F.lit(deviations) * F.col("residual_deviation")
    )


def recent_period(rows: DataFrame, months: int) -> DataFrame:
    """Rows of the last ``months`` months before the latest date."""
    latest = rows.agg(F.add_months(F.max("date"), -months)).scalar()
    return rows.where(F.col("date") >= latest)
