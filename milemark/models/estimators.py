"""The six claim models as MLlib pipelines, and the calibration of the logistic one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor, GeneralizedLinearRegression, IsotonicRegression, LinearRegression,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milemark.functions.hashing import uniform
from milemark.models.boosting import fit_boosted
from milemark.models.frames import ModelFrame, add_class_weight
from milemark.operators.labels import SEED

# Settings of the models.
MAX_LOGISTIC_ITERATIONS = 500
FOREST = {"numTrees": 200, "maxDepth": 5}
BOOSTING = {"maxIter": 200, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
CALIBRATION_FOLDS = 3
MIN_CALIBRATION_ROWS = 50

CALIBRATED = "p_calibrated"


def _assembled(features: list[str], scaled: bool) -> list:
    assembler = VectorAssembler(inputCols=features, outputCol="features_raw" if scaled else "features")
    if not scaled:
        return [assembler]
    return [assembler, StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)]


def _logistic(total_weight: float, inverse_penalty: float, suffix: str = "") -> LogisticRegression:
    """The penalty is stated for the summed loss; MLlib divides the loss by the total weight."""
    return LogisticRegression(
        featuresCol="features" + suffix,
        labelCol="label",
        weightCol="weight",
        maxIter=MAX_LOGISTIC_ITERATIONS,
        regParam=1.0 / (inverse_penalty * total_weight),
        elasticNetParam=0.0,
        standardization=False,
        predictionCol="prediction" + suffix,
        probabilityCol="probability" + suffix,
        rawPredictionCol="rawPrediction" + suffix,
    )


def _total_weight(train: DataFrame) -> float:
    return train.agg(F.sum("weight")).first()[0]


@dataclass
class Fitted:
    model: PipelineModel
    calibration: str | None = None


def fit_logistic(
    frame: ModelFrame, seed: int = SEED, inverse_penalty: float = 1.0, min_calibration_rows: int = MIN_CALIBRATION_ROWS
) -> Fitted:
    """Scaled, balanced logistic regression with calibrated probabilities.

    With enough rows of both classes, three models are fitted on two thirds each, an isotonic
    regression on the third left out maps their margins to probabilities, and the three are
    averaged. With fewer, a logistic curve through the training margins does it. With one class
    the raw probability stays. Test rows are never used.
    """
    train = add_class_weight(frame.train, "balanced")
    counts = train.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("classes")).first()
    if counts["n"] >= min_calibration_rows and counts["classes"] == 2:
        fold = F.floor(uniform(F.col("driver_id"), seed, "fold") * CALIBRATION_FOLDS)
        folded = train.withColumn("fold", fold)
        stages = []
        for k in range(CALIBRATION_FOLDS):
            suffix = f"_{k}"
            learn = folded.filter(F.col("fold") != k)
            base = Pipeline(
                stages=[
                    VectorAssembler(inputCols=frame.features, outputCol=f"features_raw{suffix}"),
                    StandardScaler(
                        inputCol=f"features_raw{suffix}", outputCol=f"features{suffix}", withMean=True, withStd=True
                    ),
                    _logistic(_total_weight(learn), inverse_penalty, suffix),
                ]
            ).fit(learn)
            curve = IsotonicRegression(
                featuresCol=f"rawPrediction{suffix}", featureIndex=1, labelCol="label", predictionCol=f"p{suffix}"
            ).fit(base.transform(folded.filter(F.col("fold") == k)))
            stages += [*base.stages, curve]
        mean = " + ".join(f"p_{k}" for k in range(CALIBRATION_FOLDS))
        stages.append(SQLTransformer(statement=f"SELECT *, ({mean}) / {CALIBRATION_FOLDS} AS {CALIBRATED} FROM __THIS__"))
        return Fitted(PipelineModel(stages), "isotonic_cv3")

    base = Pipeline(
        stages=[*_assembled(frame.features, True), _logistic(_total_weight(train), inverse_penalty)]
    ).fit(train)
    if counts["classes"] < 2:
        return Fitted(base, "uncalibrated")
    curve = LogisticRegression(
        featuresCol="rawPrediction", labelCol="label", probabilityCol="probability_calibrated",
        rawPredictionCol="raw_calibrated", predictionCol="prediction_calibrated",
    ).fit(base.transform(train))
    return Fitted(PipelineModel([*base.stages, curve]), "sigmoid_prefit")


def fit_forest(frame: ModelFrame, seed: int = SEED) -> Fitted:
    train = add_class_weight(frame.train, "balanced")
    forest = RandomForestClassifier(labelCol="label", weightCol="weight", seed=seed, **FOREST)
    return Fitted(Pipeline(stages=[*_assembled(frame.features, False), forest]).fit(train))


def fit_boosted_classifier(frame: ModelFrame, seed: int = SEED) -> Fitted:
    train = add_class_weight(frame.train, "positive_ratio")
    boosted = GBTClassifier(labelCol="label", weightCol="weight", seed=seed, **BOOSTING)
    return Fitted(PipelineModel([*_assembled(frame.features, False), fit_boosted(train, frame.features, boosted)]))


def fit_linear(frame: ModelFrame, seed: int = SEED) -> Fitted:
    linear = LinearRegression(labelCol="label")
    return Fitted(Pipeline(stages=[*_assembled(frame.features, True), linear]).fit(frame.train))


def fit_boosted_regressor(frame: ModelFrame, seed: int = SEED) -> Fitted:
    boosted = GBTRegressor(labelCol="label", seed=seed, **BOOSTING)
    return Fitted(PipelineModel([*_assembled(frame.features, False), fit_boosted(frame.train, frame.features, boosted)]))


def fit_gamma(frame: ModelFrame, seed: int = SEED, penalty: float = 1.0) -> Fitted:
    """Gamma regression with log link; only positive amounts have a likelihood."""
    glm = GeneralizedLinearRegression(
        family="gamma", link="log", labelCol="label", regParam=penalty, maxIter=100
    )
    train = frame.train.filter(F.col("label") > 0)
    return Fitted(Pipeline(stages=[*_assembled(frame.features, True), glm]).fit(train))


@dataclass(frozen=True)
class Spec:
    name: str
    title: str
    kind: str
    fit: Callable[..., Fitted]


SPECS = [
    Spec("frequency_logit", "Frequency — Logistic Regression", "Frequency", fit_logistic),
    Spec("frequency_rf", "Frequency — Random Forest", "Frequency", fit_forest),
    Spec("frequency_xgb", "Frequency — Boosted Trees", "Frequency", fit_boosted_classifier),
    Spec("severity_linreg", "Severity — Linear Regression", "Severity", fit_linear),
    Spec("severity_xgb", "Severity — Boosted Trees", "Severity", fit_boosted_regressor),
    Spec("severity_gamma_glm", "Severity — Gamma GLM", "Severity", fit_gamma),
]
SPECS_BY_NAME = {spec.name: spec for spec in SPECS}
