import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from milemark.models import boosting, estimators, frames
from milemark.session import scratch_path

NAMES = ["fine", "coarse", "noise"]
WHOLE = {**estimators.BOOSTING, "maxIter": 12, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3000
    table = pd.DataFrame({
        "row_id": range(n), "fine": rng.integers(0, 300, n) / 3, "coarse": rng.integers(0, 4, n) * 1.0,
        "noise": rng.integers(0, 400, n) / 400, "weight": rng.integers(1, 4, n) * 1.0,
    })
    table["amount"] = table.fine * (1 + table.coarse) + rng.normal(0, 5, n)
    table["claim"] = (table.amount > 100).astype(float)
    path = scratch_path(spark, "boosting")
    spark.createDataFrame(table).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def both(rows, estimator):
    """Predictions of MLlib's own fit and of the histograms, by row."""
    table = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    models = estimator.fit(table), boosting.fit_boosted(rows, NAMES, estimator)
    column = "rawPrediction" if isinstance(estimator, GBTClassifier) else "prediction"
    found = [m.transform(table).orderBy("row_id").select(F.col(column).cast("string").alias("p")).toPandas().p for m in models]
    return models, [np.array([float(p.strip("[]").split(",")[-1]) for p in ps]) for ps in found]


def test_without_draws_the_trees_are_those_of_mllib(rows):
    for estimator in (
        GBTRegressor(labelCol="amount", seed=5, **WHOLE),
        GBTClassifier(labelCol="claim", weightCol="weight", seed=5, **WHOLE),
    ):
        (theirs, ours), (a, b) = both(rows, estimator)
        assert np.abs(a - b).max() < 1e-9 and a.std() > 0
        assert ours.getNumTrees == 12 and ours.totalNumNodes == theirs.totalNumNodes
        assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


def test_many_blocks_give_the_model_of_one(rows, monkeypatch):
    estimator = GBTRegressor(labelCol="amount", seed=5, **WHOLE)
    one = boosting.fit_boosted(rows, NAMES, estimator)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    many = boosting.fit_boosted(rows, NAMES, estimator)
    assert [t.numNodes for t in many.trees] == [t.numNodes for t in one.trees]
    table = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    sums = [m.transform(table).agg(F.sum("prediction"), F.sum(F.col("prediction") * F.col("row_id"))).first() for m in (one, many)]
    assert tuple(sums[0]) == pytest.approx(tuple(sums[1]))


def test_sampled_rounds_still_learn(rows):
    for estimator in (
        GBTRegressor(labelCol="amount", seed=5, **{**estimators.BOOSTING, "maxIter": 40}),
        GBTClassifier(labelCol="claim", weightCol="weight", seed=5, **{**estimators.BOOSTING, "maxIter": 40}),
    ):
        _, (a, b) = both(rows, estimator)
        assert np.corrcoef(a, b)[0, 1] > 0.98


def test_equal_rows_are_drawn_one_by_one():
    n = np.array([1] * 4000 + [1000] * 400)
    taken = boosting._sampled(n, 0.8, [1, 2, 3])
    assert abs(taken[:4000].mean() - 0.8) < 0.03 and set(taken[:4000]) == {0, 1}
    assert abs(taken[4000:].mean() - 800) < 3 and 9 < taken[4000:].std() < 16
    assert (taken == boosting._sampled(n, 0.8, [1, 2, 3])).all()


def test_rounds_over_few_kinds_of_rows_need_no_jobs(spark, rows):
    few = rows.select("row_id", F.col("coarse").alias("x"), (F.col("coarse") * 7).alias("label"))
    frame = frames.ModelFrame(few, few, ["x"], False)
    spark.sparkContext.setJobGroup("boosting", "one fit")
    try:
        model = estimators.fit_boosted_regressor(frame).model
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("boosting")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 20 and model.stages[-1].getNumTrees == 200
    assert model.transform(few).filter(F.abs(F.col("prediction") - F.col("label")) > 1e-9).count() == 0


def test_models_are_saved_and_their_settings_with_them(spark, rows):
    frame = frames.ModelFrame(rows.withColumn("label", F.col("claim")), rows, NAMES, False)
    model = estimators.fit_boosted_classifier(frame).model
    path = scratch_path(spark, "boosted")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).stages[-1]
    assert again.getMaxIter() == 200 and again.getWeightCol() == "weight" and again.getSubsamplingRate() == 0.8
    assert again.trees[7].toDebugString.split("\n", 1)[1] == model.stages[-1].trees[7].toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("change", [{"amount": None}, {"fine": float("nan")}])
def test_rows_without_label_or_feature_are_refused(rows, change):
    (column, value), = change.items()
    spoiled = rows.withColumn(column, F.when(F.col("row_id") == 7, F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(ValueError, match="neither null nor NaN"):
        boosting.fit_boosted(spoiled, NAMES, GBTRegressor(labelCol="amount", **WHOLE))
