"""Column expressions of the claim and premium arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the risk score, base claim probability, premium loadings.
RISK_WEIGHTS = {
    "harsh_brake_rate": 0.6,
    "harsh_accel_rate": 0.6,
    "night_trip_ratio": 0.2,
    "trip_count": 0.001,
}
BASE_CLAIM_PROBABILITY = 0.20
EXPENSE_LOAD = 0.25
MARGIN_LOAD = 0.10


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def risk_score(weights: dict[str, float] = RISK_WEIGHTS) -> Column:
    terms = [F.lit(weight) * zero_if_null(F.col(name)) for name, weight in weights.items()]
    return sum(terms[1:], terms[0])


def claim_probability(
    base: float = BASE_CLAIM_PROBABILITY,
    weights: dict[str, float] = RISK_WEIGHTS,
    use_feature_weights: bool = True,
) -> Column:
    """The base probability, shifted on the logit scale by the driver's risk score."""
    if not use_feature_weights:
        return F.lit(base)
    return logistic(logit(F.lit(base)) + risk_score(weights))


def claim_amount(occurred: Column, severity: Column, total_km: Column, speed_std: Column) -> Column:
    """Severity grows with distance driven and with speed volatility; no claim costs nothing."""
    exposure = 1 + zero_if_null(total_km) / 1000
    volatility = 1 + zero_if_null(speed_std) / 10
    return F.when(occurred, severity * exposure * volatility).otherwise(F.lit(0.0))


def clip_probability(p: Column) -> Column:
    # greatest/least skip nulls, so an unknown probability must be kept unknown explicitly
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def clip_severity(amount: Column) -> Column:
    return F.when(amount.isNotNull(), F.greatest(amount, F.lit(0.0)))


def expected_loss(p: Column, severity: Column) -> Column:
    return p * severity


def premium(
    loss: Column, expense_load: float = EXPENSE_LOAD, margin_load: float = MARGIN_LOAD
) -> Column:
    return loss * (1 + expense_load + margin_load)


def residual(y_true: Column, y_pred: Column) -> Column:
    return y_true - y_pred
