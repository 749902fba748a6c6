"""Model input: label names unified, features filled, sides split, class weights attached."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.operators.cleaning import claimants, numeric_features, unify_label_names
from milemark.operators.labels import SEED, split_is_usable, with_split
from milemark.operators.metrics import class_weights
from milemark.session import store

MIN_SPLIT_ROWS = 10
FRAME_FILE_ROWS = 10_000


@dataclass
class ModelFrame:
    """Training and test rows with columns driver_id, row_id, label, and the features."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    was_split: bool


def row_key() -> Column:
    """A numeric key of the driver: the order of ties in the metrics."""
    return F.xxhash64("driver_id")


def _frame(labelled: DataFrame, label: Column, positive: Column, seed: int, min_rows: int) -> ModelFrame:
    features = numeric_features(labelled)
    rows = with_split(labelled, "driver_id", seed).select(
        "driver_id",
        row_key().alias("row_id"),
        label.cast("double").alias("label"),
        positive.alias("_positive"),
        "is_test",
        # a feature that could not be computed counts as 0, as in the risk score
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features],
    )
    # iterative solvers pass over the rows many times: written once, in files so small that all cores get some
    rows = store(rows.hint("rebalance"), "model-frame", FRAME_FILE_ROWS)
    usable = split_is_usable(rows, "_positive", min_rows).first()["usable"]
    rows = rows.drop("_positive")
    if not usable:
        both = rows.drop("is_test")
        return ModelFrame(both, both, features, False)
    return ModelFrame(
        rows.filter(~F.col("is_test")).drop("is_test"), rows.filter("is_test").drop("is_test"), features, True
    )


def frequency_frame(training: DataFrame, seed: int = SEED, min_rows: int = MIN_SPLIT_ROWS) -> ModelFrame:
    """Every driver; the label tells whether a claim occurred."""
    unified = unify_label_names(training)
    occurred = F.col("had_claim_within_30d").cast("int")
    return _frame(unified, occurred, occurred, seed, min_rows)


def severity_frame(training: DataFrame, seed: int = SEED, min_rows: int = MIN_SPLIT_ROWS) -> ModelFrame | None:
    """Drivers with a claim; the label is its amount. ``None`` without claims.

    The split asks for two classes on both sides; for amounts these are above and up to the mean.
    """
    claims = claimants(unify_label_names(training), "had_claim_within_30d")
    summary = claims.agg(F.count(F.lit(1)).alias("n"), F.avg("claim_severity").alias("mean")).first()
    if summary["n"] == 0:
        return None
    return _frame(claims, F.col("claim_severity"), F.col("claim_severity") > F.lit(summary["mean"]), seed, min_rows)


def add_class_weight(train: DataFrame, scheme: str) -> DataFrame:
    """Add ``weight``: ``balanced`` gives both classes the same total, ``positive_ratio`` weighs a
    positive like the negatives per positive."""
    row = class_weights(train, "label").first()
    if scheme == "balanced":
        positive, negative = row["weight_positive"], row["weight_negative"]
    elif scheme == "positive_ratio":
        positive, negative = row["scale_pos_weight"], 1.0
    else:
        raise ValueError(f"unknown weight scheme {scheme!r}")
    weight = F.when(F.col("label") > 0, F.lit(positive)).otherwise(F.lit(negative))
    return train.withColumn("weight", weight.cast("double"))
