"""Composite jobs from features to premiums: labels, training, scoring, pricing."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.functions.hashing import table_fingerprint
from milemark.models import scoring
from milemark.models.estimators import SPECS, Fitted, Spec
from milemark.models.frames import ModelFrame, frequency_frame, severity_frame
from milemark.operators import labels, metrics, monitoring
from milemark.schemas import MODEL_SUMMARY, REGISTRY, conform
from milemark.session import store
from milemark.sources import readers, writers


def build_training_set(
    spark: SparkSession, gold: str, training: str, manifests: str | None = None, seed: int = labels.SEED, **options
) -> DataFrame:
    """Draw labels on the Gold table and write the training set with its manifest."""
    writers.write_gold(labels.training_set(readers.read_table(spark, gold), seed, **options), training)
    written = readers.read_table(spark, training)
    if manifests is not None:
        parameters = {"gamma_shape": labels.GAMMA_SHAPE, "gamma_scale": labels.GAMMA_SCALE, "random_seed": seed}
        totals = {
            "rows": F.count(F.lit(1)),
            "positives": F.count_if(F.col("claim_occurred")),
            "claim_rate": F.avg(F.col("claim_occurred").cast("int")),
            "mean_severity": F.avg("claim_amount"),
            "max_severity": F.max("claim_amount"),
        }
        writers.append_manifest(writers.manifest(written, totals, parameters), manifests)
    return written


@dataclass
class Trained:
    """One model with its test predictions and its metric row."""

    spec: Spec
    fitted: Fitted
    predictions: DataFrame
    metrics: DataFrame


def evaluate(predictions: DataFrame, kind: str, intervals: bool = False) -> DataFrame:
    """One metric row: AUC, PR, Brier for a frequency model, MAE, RMSE, R2, NormGini for a severity one;
    on request the 95 % intervals of AUC and PR, or of MAE."""
    if kind == "Frequency":
        row, bounded = metrics.classification_metrics(predictions), ["AUC", "PR"]
    else:
        row = metrics.regression_metrics(predictions).withColumn(
            "NormGini", metrics.normalized_gini(predictions).select("NormGini").scalar()
        )
        bounded = ["MAE"]
    row = row.withColumnRenamed("n", "n_test")
    if intervals:
        for name in bounded:
            both = metrics.bootstrap_interval(predictions, name).select(F.struct("lower", "upper").alias("both"))
            row = row.withColumn("_ends", both.scalar())  # one subquery for both ends
            row = row.withColumns({f"{name}_CI_low": F.col("_ends.lower"), f"{name}_CI_high": F.col("_ends.upper")})
            row = row.drop("_ends")
    return row


def train_one(spec: Spec, frame: ModelFrame, intervals: bool = False) -> Trained:
    fitted = spec.fit(frame)
    predictions = store(scoring.predict(fitted.model, frame.test, spec.kind), spec.name)
    n_train = frame.train.agg(F.count(F.lit(1))).first()[0]
    row = evaluate(predictions, spec.kind, intervals).select(
        F.lit(spec.name).alias("name"),
        F.lit(spec.title).alias("Model"),
        F.lit(fitted.calibration).cast("string").alias("calibration"),
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.lit(frame.was_split).alias("was_split"),  # else the figures are those of the training rows
        "*",
    )
    return Trained(spec, fitted, predictions, row)


def train_models(
    training: DataFrame,
    models_dir: str,
    predictions_dir: str,
    summary_path: str,
    registry_path: str,
    specs: list[Spec] = SPECS,
    intervals: bool = False,
    version: str = "v1",
) -> DataFrame:
    """Fit, evaluate and save the models; write predictions, the summary and registry entries.

    Severity models are skipped when no claim occurred. Returns the metric rows side by side.
    """
    spark = training.sparkSession
    data = store(training, "training")  # read by every model
    data_hash = table_fingerprint(data).first()["data_hash"]
    frames = {"Frequency": frequency_frame(data), "Severity": severity_frame(data)}
    rows, entries = [], []
    for spec in specs:
        frame = frames[spec.kind]
        if frame is None:
            continue
        trained = train_one(spec, frame, intervals)
        artifact = f"{models_dir}/{spec.name}"
        trained.fitted.model.write().overwrite().save(artifact)
        trained.predictions.write.mode("overwrite").parquet(f"{predictions_dir}/{spec.name}")
        now = datetime.now(timezone.utc).isoformat()
        metrics_path = f"{predictions_dir}/{spec.name}_metrics"
        row = store(
            trained.metrics.withColumns(
                {"config_hash": F.lit("-"), "run_time": F.lit(now), "artifact": F.lit(artifact)}
            ),
            f"{spec.name}-metrics",
        )
        row.write.mode("overwrite").json(metrics_path)
        rows.append(row)
        entries.append((spec.name, version, data_hash, artifact, metrics_path, now, "train"))
    summary = metrics.compare_models(rows)
    writers.write_csv(conform(summary, MODEL_SUMMARY), summary_path)
    spark.createDataFrame(entries, REGISTRY).coalesce(1).write.mode("append").json(registry_path)
    return summary


def score_drivers(
    spark: SparkSession, training: str, summary_path: str, scores: str,
    preview: str | None = None, manifests: str | None = None, models_dir: str | None = None,
) -> DataFrame:
    """Load the best pair of models, write the risk scores, a preview and the manifest.

    Without a summary, or where it names no model of a kind, the default models below ``models_dir`` score.
    """
    summary = readers.optional(readers.read_model_summary, spark, summary_path)
    if summary is None:
        summary = spark.createDataFrame([], MODEL_SUMMARY)
    best = monitoring.best_models(summary, models_dir).first()
    frequency = PipelineModel.load(best["frequency_artifact"])
    severity = PipelineModel.load(best["severity_artifact"])
    scored = scoring.score(readers.read_table(spark, training), frequency, severity)
    scored.write.mode("overwrite").parquet(scores)
    written = readers.read_table(spark, scores)
    if preview is not None:
        writers.write_preview(written, preview, ["driver_id"])
    if manifests is not None:
        row = writers.manifest(
            written,
            {"rows": F.count(F.lit(1)), "drivers": F.count_distinct("driver_id")},
            {
                "frequency_model": best["frequency_artifact"],
                "severity_model": best["severity_artifact"],
                "output": scores,
            },
        )
        writers.append_manifest(row, manifests)
    return written


def price_premiums(
    spark: SparkSession, scores: str, premiums: str, manifests: str | None = None, **loads
) -> DataFrame:
    labels.with_premium(readers.read_table(spark, scores), **loads).write.mode("overwrite").parquet(premiums)
    written = readers.read_table(spark, premiums)
    if manifests is not None:
        parameters = {"input": scores, "output": premiums, **loads}
        writers.append_manifest(writers.manifest(written, {"rows": F.count(F.lit(1))}, parameters), manifests)
    return written
