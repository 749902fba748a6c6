"""Applying fitted models: probabilities, severities, predictions, weights of the features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.functions.actuarial import clip_probability, clip_severity, expected_loss, logistic
from milemark.models.estimators import CALIBRATED
from milemark.operators.cleaning import numeric_features, unify_label_names


def probability_of_margin(raw_prediction: Column) -> Column:
    """Sigmoid of the positive class's margin, for a model without probabilities."""
    return logistic(vector_to_array(raw_prediction)[1])


def positive_probability(probability: Column) -> Column:
    return vector_to_array(probability)[1]


def claim_probability(scored: DataFrame) -> Column:
    """The best probability a model's output offers: calibrated, its own, from its margin, or as is."""
    columns = scored.columns
    if CALIBRATED in columns:
        return F.col(CALIBRATED)
    if "probability_calibrated" in columns:
        return positive_probability(F.col("probability_calibrated"))
    if "probability" in columns:
        return positive_probability(F.col("probability"))
    if "rawPrediction" in columns:
        return probability_of_margin(F.col("rawPrediction"))
    return F.col("prediction").cast("double")


def predict(model: PipelineModel, rows: DataFrame, kind: str) -> DataFrame:
    """(driver_id, row_id, y_true, y_pred) of labelled rows."""
    scored = model.transform(rows)
    value = claim_probability(scored) if kind == "Frequency" else clip_severity(F.col("prediction"))
    return scored.select("driver_id", "row_id", F.col("label").alias("y_true"), value.alias("y_pred"))


def _filled(training: DataFrame) -> DataFrame:
    features = numeric_features(training)
    return training.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def score(training: DataFrame, frequency: PipelineModel, severity: PipelineModel) -> DataFrame:
    """The risk-score table: both models run over the same rows, without a join."""
    rows = _filled(unify_label_names(training))
    carried = rows.columns
    with_p = frequency.transform(rows)
    with_p = with_p.select(*carried, clip_probability(claim_probability(with_p)).alias("p_claim_30d"))
    with_both = severity.transform(with_p).withColumn("severity_pred", clip_severity(F.col("prediction")))
    out = with_both.withColumn("expected_loss", expected_loss(F.col("p_claim_30d"), F.col("severity_pred")))
    kept = ["driver_id", "p_claim_30d", "severity_pred", "expected_loss"]
    return out.select(*kept, *(["total_km"] if "total_km" in training.columns else []))


def join_scores(probabilities: DataFrame, severities: DataFrame, features: DataFrame) -> DataFrame:
    """The same table from scores that were stored apart, matched by driver; a driver that one side lacks stays,
    without a loss."""
    p = probabilities.select("driver_id", clip_probability(F.col("y_pred")).alias("p_claim_30d"))
    amount = severities.select("driver_id", clip_severity(F.col("y_pred")).alias("severity_pred"))
    joined = p.join(amount, "driver_id", "full_outer").join(features.select("driver_id", "total_km"), "driver_id", "left")
    loss = expected_loss(F.col("p_claim_30d"), F.col("severity_pred"))
    return joined.select("driver_id", "p_claim_30d", "severity_pred", loss.alias("expected_loss"), "total_km")


def feature_weights(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """(feature, kind, weight): coefficients of linear models, importances of trees.

    The averaged logistic model contributes the mean of its three coefficients.
    """
    linear, trees = [], []
    for stage in model.stages:
        if hasattr(stage, "featureImportances"):
            trees.append(stage.featureImportances.toArray())
        elif hasattr(stage, "coefficients") and len(stage.coefficients) == len(features):
            linear.append(stage.coefficients.toArray())
    kind, found = ("importance", trees) if trees else ("coefficient", linear)
    rows = [
        (feature, kind, float(sum(v[i] for v in found) / len(found))) for i, feature in enumerate(features)
    ]
    return spark.createDataFrame(rows, "feature string, kind string, weight double")
