"""Synthetic claim labels on driver features, and the scoring arithmetic built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milemark.functions import actuarial, hashing
from milemark.schemas import TRAINING_SET, conform

# Severity distribution and seed.
GAMMA_SHAPE = 2.0
GAMMA_SCALE = 500.0
SEED = 42


def with_claim_probability(features: DataFrame, **options) -> DataFrame:
    return features.withColumn("claim_probability", actuarial.claim_probability(**options))


def with_claims(
    features: DataFrame, seed: int = SEED, shape: float = GAMMA_SHAPE, scale: float = GAMMA_SCALE
) -> DataFrame:
    """Draw occurrence and amount from the driver's key; needs ``claim_probability``."""
    key = F.col("driver_id")
    drawn = features.withColumn(
        "claim_occurred", hashing.bernoulli(F.col("claim_probability"), key, seed)
    ).withColumn("severity", hashing.gamma(key, seed, shape, scale))
    return drawn.withColumn(
        "claim_amount",
        actuarial.claim_amount(F.col("claim_occurred"), F.col("severity"), F.col("total_km"), F.col("speed_std")),
    )


def training_set(
    features: DataFrame,
    seed: int = SEED,
    shape: float = GAMMA_SHAPE,
    scale: float = GAMMA_SCALE,
    **probability_options,
) -> DataFrame:
    """Features with drawn labels, in the training contract."""
    labelled = with_claims(with_claim_probability(features, **probability_options), seed, shape, scale)
    return conform(labelled, TRAINING_SET)


def training_totals(training: DataFrame) -> DataFrame:
    """One row for the manifest; amounts are over all rows, claim or not."""
    return training.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("claim_occurred")).alias("positives"),
        F.avg(F.col("claim_occurred").cast("int")).alias("claim_rate"),
        F.avg("claim_amount").alias("mean_severity"),
        F.max("claim_amount").alias("max_severity"),
    )


def clip_scores(scores: DataFrame, p: str = "p_raw", severity: str = "severity_raw") -> DataFrame:
    return scores.withColumns(
        {
            "p_claim_30d": actuarial.clip_probability(F.col(p)),
            "severity_pred": actuarial.clip_severity(F.col(severity)),
        }
    )


def with_expected_loss(scores: DataFrame) -> DataFrame:
    loss = actuarial.expected_loss(F.col("p_claim_30d"), F.col("severity_pred"))
    return scores.withColumn("expected_loss", loss)


def with_premium(
    scores: DataFrame,
    expense_load: float = actuarial.EXPENSE_LOAD,
    margin_load: float = actuarial.MARGIN_LOAD,
) -> DataFrame:
    if "expected_loss" not in scores.columns:
        raise ValueError("risk scores lack the column expected_loss")
    return scores.withColumn("premium", actuarial.premium(F.col("expected_loss"), expense_load, margin_load))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / population deviation, as SQL; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    out = {}
    for c in columns:
        centred = F.col(c) - stats.select(f"m_{c}").scalar()
        deviation = stats.select(f"s_{c}").scalar()
        out[c] = F.when(deviation == 0, F.lit(0.0)).otherwise(centred / deviation)
    return df.withColumns(out)


def with_split(
    df: DataFrame, group: str = "driver_id", seed: int = SEED, test_share: float = 0.2
) -> DataFrame:
    """Add ``is_test``: a group goes to the test side as a whole, by a hash of its key."""
    return df.withColumn("is_test", hashing.uniform(F.col(group), seed, "split") < test_share)


def split_is_usable(split: DataFrame, label: str, min_rows: int = 10) -> DataFrame:
    """One row (rows, usable): at least ``min_rows`` rows and both classes on both sides."""
    positive = F.col(label).cast("double") > 0
    counts = split.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("is_test") & positive).alias("test_positives"),
        F.count_if(F.col("is_test") & ~positive).alias("test_negatives"),
        F.count_if(~F.col("is_test") & positive).alias("train_positives"),
        F.count_if(~F.col("is_test") & ~positive).alias("train_negatives"),
    )
    smallest = F.least("test_positives", "test_negatives", "train_positives", "train_negatives")
    return counts.withColumn("usable", (F.col("rows") >= min_rows) & (smallest > 0))
