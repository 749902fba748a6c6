"""Quality reports as composite jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milemark.operators import cleaning, distribution, validation

# The features whose means the training report shows.
REPORTED_FEATURES = [
    "trip_count", "avg_speed_mps", "harsh_brake_rate", "harsh_accel_rate", "overspeed_rate",
    "night_trip_ratio", "total_km",
]


def training_report(training: DataFrame) -> DataFrame:
    """(section, item, value): rows, label shares, claim statistics, feature means."""
    rows = training.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("rows").alias("section"), F.lit("rows").alias("item"), "value"
    )
    shares = distribution.value_counts(training, "claim_occurred").select(
        F.lit("label share").alias("section"), F.col("value").cast("string").alias("item"),
        F.round("share", 3).alias("value"),
    )
    claims = distribution.describe(cleaning.claimants(training), ["claim_amount"])
    names = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    statistics = claims.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("item"), F.round(F.col(n).cast("double"), 2).alias("value"))
                    for n in names
                ]
            )
        ).alias("s")
    ).select(F.lit("claims").alias("section"), "s.*")
    means = distribution.feature_means(training, REPORTED_FEATURES).select(
        F.lit("feature mean").alias("section"), F.col("column").alias("item"), F.round("mean", 3).alias("value")
    )
    return reduce(DataFrame.unionByName, [rows, shares, statistics, means])


def silver_quality(events: DataFrame, parts: list[str] | None = None) -> dict[str, DataFrame]:
    """The Silver checks, or the named ones: violation counts, illegal sources, symbols found, nulls, contract,
    profile and correlations. Building the profile already reads the events, for the edges of its quantiles."""
    numeric = [
        c for c in ("lat", "lon", "speed_mps", "accel_mps2", "gyro", "heading", "odometer_km") if c in events.columns
    ]
    checks = {
        "violations": lambda: validation.silver_report(events),
        "sources": lambda: validation.illegal_sources(events),
        "domains": lambda: validation.domain_report(events),
        "nulls": lambda: validation.null_report(events),
        "contract": lambda: validation.contract_report(events),
        "profile": lambda: distribution.profile(events, numeric),
        "correlations": lambda: distribution.correlations(events, numeric),
    }
    return {name: make() for name, make in checks.items() if parts is None or name in parts}


def table_quality(features: DataFrame, training: DataFrame, manifest: DataFrame) -> dict[str, DataFrame]:
    """The checks of the tables after Silver: rules of the features, and the training set against its manifest."""
    return {
        "rules": validation.gold_rules(features),
        "training": validation.training_consistency(training, manifest),
    }
