"""Monitoring views as composite jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milemark.operators import distribution, metrics, monitoring


def _unpivot(row: DataFrame, section: str) -> DataFrame:
    return row.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in row.columns]
            )
        ).alias("s")
    ).select(F.lit(section).alias("section"), "s.*")


def overview(
    layers: dict[str, DataFrame], training: DataFrame | None = None, premiums: DataFrame | None = None
) -> DataFrame:
    """(section, item, value): layer sizes, key figures of the training set and of the premiums."""
    parts = [
        monitoring.layer_counts(layers).select(
            F.lit("layer rows").alias("section"), F.col("layer").alias("item"), F.col("rows").cast("double").alias("value")
        )
    ]
    if training is not None:
        parts.append(_unpivot(monitoring.claim_kpis(training), "training"))
    if premiums is not None:
        parts.append(_unpivot(monitoring.premium_kpis(premiums), "premiums"))
    return reduce(DataFrame.unionByName, parts)


def feature_views(features: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Statistics, one histogram per feature, boxes and correlations of the Gold table."""
    return {
        "statistics": distribution.describe(features, columns),
        "boxes": distribution.box_statistics(features, columns),
        "correlations": distribution.correlations(features, columns),
        **{f"histogram of {c}": distribution.histogram(features, c) for c in columns},
    }


def frequency_views(predictions: DataFrame) -> dict[str, DataFrame]:
    """ROC curve, distribution by label and calibration of a frequency model."""
    return {
        "roc": metrics.roc_curve(predictions),
        "distribution": distribution.histogram(predictions, "y_pred", by=["y_true"]),
        "calibration": metrics.calibration_table(predictions),
    }


def severity_views(predictions: DataFrame) -> dict[str, DataFrame]:
    """Trend of prediction on outcome, and the residuals, of a severity model."""
    residuals = predictions.withColumn("residual", F.col("y_true") - F.col("y_pred"))
    return {"trend": metrics.ols_trend(predictions), "residuals": distribution.histogram(residuals, "residual")}
