import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from milemark.models import estimators, frames, scoring
from milemark.plans import learning
from milemark.schemas import TRAINING_SET, conform
from milemark.session import scratch_path
from milemark.sources import readers


def training(spark, n, seed=1, claim_share=0.3):
    rng = np.random.default_rng(seed)
    km = rng.uniform(0, 1000, n)
    occurred = rng.random(n) < claim_share * 2 * km / 1000
    rows = pd.DataFrame({
        "driver_id": [f"d{i}" for i in range(n)], "trip_count": rng.integers(1, 9, n), "total_events": rng.integers(1, 99, n),
        "avg_speed_mps": rng.normal(14, 3, n), "speed_std": rng.normal(5, 1, n), "harsh_brake_rate": rng.random(n),
        "harsh_accel_rate": rng.random(n), "overspeed_rate": rng.random(n), "night_trip_ratio": rng.random(n),
        "weekend_trip_ratio": rng.random(n), "total_km": km, "claim_occurred": occurred,
        "claim_amount": np.where(occurred, rng.gamma(2, 500, n) + km, 0.0),
    })
    return conform(spark.createDataFrame(rows), TRAINING_SET)


@pytest.fixture(scope="module")
def data(spark):
    return training(spark, 300)


def test_labels_never_become_features(data):
    frame = frames.frequency_frame(data)
    assert set(frame.features) == set(data.columns) - {"driver_id", "claim_occurred", "claim_amount"}
    assert frame.was_split and frame.train.join(frame.test, "driver_id").count() == 0


def test_small_or_one_sided_data_is_not_split(spark, data):
    frame = frames.frequency_frame(data.limit(9))
    assert not frame.was_split and frame.train.count() == frame.test.count() == 9
    assert frames.severity_frame(data.withColumn("claim_occurred", F.lit(False))) is None


def test_calibration_modes(spark, data):
    fitted = estimators.fit_logistic(frames.frequency_frame(data))
    assert fitted.calibration == "isotonic_cv3"
    few = frames.frequency_frame(training(spark, 40, 2))
    assert estimators.fit_logistic(few).calibration == "sigmoid_prefit"
    one_class = frames.frequency_frame(data.withColumn("claim_occurred", F.lit(False)).limit(60))
    assert estimators.fit_logistic(one_class).calibration == "uncalibrated"


def test_logistic_ranks_and_weighs(spark, data):
    frame = frames.frequency_frame(data)
    fitted = estimators.fit_logistic(frame)
    predictions = scoring.predict(fitted.model, frame.train, "Frequency")
    low, high = predictions.agg(F.min("y_pred"), F.max("y_pred")).first()
    assert 0 <= low < high <= 1
    assert learning.evaluate(predictions, "Frequency").first()["AUC"] > 0.6
    weights = {r["feature"]: r["weight"] for r in scoring.feature_weights(fitted.model, frame.features, spark).collect()}
    assert max(weights, key=weights.get) == "total_km"


def test_severity_predictions_are_not_negative(data):
    frame = frames.severity_frame(data)
    for fit in (estimators.fit_linear, estimators.fit_gamma):
        predictions = scoring.predict(fit(frame).model, frame.test, "Severity")
        assert predictions.filter("y_pred < 0").count() == 0
        assert learning.evaluate(predictions, "Severity", intervals=True).first()["MAE_CI_low"] > 0


def test_train_save_score(spark, data):
    base = scratch_path(spark, "models")
    data.write.parquet(f"{base}/training")
    chosen = [estimators.SPECS_BY_NAME["frequency_logit"], estimators.SPECS_BY_NAME["severity_linreg"]]
    summary = learning.train_models(
        data, f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry", chosen
    )
    assert {r["name"] for r in summary.collect()} == {"frequency_logit", "severity_linreg"}
    registry = readers.read_registry(spark, f"{base}/registry")
    assert registry.count() == 2 and registry.select("data_hash").distinct().count() == 1
    scores = learning.score_drivers(
        spark, f"{base}/training", f"{base}/summary", f"{base}/scores", f"{base}/preview", f"{base}/manifest"
    )
    assert scores.count() == 300
    wrong = F.abs(F.col("expected_loss") - F.col("p_claim_30d") * F.col("severity_pred")) > 1e-9
    assert scores.filter(wrong | ~F.col("p_claim_30d").between(0, 1) | (F.col("severity_pred") < 0)).count() == 0
    assert spark.read.csv(f"{base}/preview", header=True).count() == 20
    assert readers.read_json_documents(spark, f"{base}/manifest").first()["drivers"] == 300
    model = PipelineModel.load(f"{base}/models/frequency_logit")
    again = scoring.score(data, model, PipelineModel.load(f"{base}/models/severity_linreg"))
    assert again.agg(F.sum("expected_loss")).first()[0] == pytest.approx(scores.agg(F.sum("expected_loss")).first()[0])


def test_trees_are_configured_as_stated(data):
    assert estimators.FOREST == {"numTrees": 200, "maxDepth": 5}
    assert estimators.BOOSTING["maxIter"] == 200 and estimators.BOOSTING["stepSize"] == 0.1
    frame = frames.frequency_frame(data)
    model = estimators.fit_forest(frame).model.stages[-1]
    assert model.getNumTrees == 200 and model.getMaxDepth() == 5


def test_frames_are_files_for_many_tasks(data, monkeypatch):
    monkeypatch.setattr(frames, "FRAME_FILE_ROWS", 50)
    assert len(frames.frequency_frame(data).train.inputFiles()) >= 6


@pytest.mark.parametrize("name", ["ml13_feature_weights", "ml10_saved_model"])
def test_queries_build_their_training_set_once(spark, monkeypatch, name):
    from milemark.catalog import learning as catalog
    from milemark.catalog import registry

    built = []
    table = registry.training_table
    monkeypatch.setattr(catalog, "training_table", lambda *a: built.append(1) or table(*a))
    monkeypatch.setattr(catalog, "training", lambda *a: pytest.fail("a training set that is not written"))
    registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert built == [1]


def test_the_default_pair_is_what_its_names_say(spark, small, monkeypatch):
    from milemark.catalog import learning as catalog

    found = {}
    score = learning.score_drivers

    def noted(*args):
        for name in ("frequency_rf", "severity_xgb"):
            found[name] = PipelineModel.load(f"{args[-1]}/{name}").stages[-1]
        return score(*args)

    monkeypatch.setattr(learning, "score_drivers", noted)
    catalog.jb7(spark, small)
    forest, boosted = found["frequency_rf"], found["severity_xgb"]
    assert type(forest).__name__ == "RandomForestClassificationModel" and forest.getNumTrees == 200
    assert type(boosted).__name__ == "GBTRegressionModel" and boosted.getNumTrees == 200
