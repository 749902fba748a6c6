import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from milemark.operators import distribution, labels, metrics, monitoring

SCHEMA = "row_id bigint, y_true double, y_pred double"


def frame(spark, rows):
    return spark.createDataFrame([(i, float(y), float(p)) for i, (y, p) in enumerate(rows)], SCHEMA)


def tied_rows(seed, n=300):
    rng = random.Random(seed)
    # a third of all rows share one score
    return [(int(rng.random() < 0.3), 0.5 if i % 3 == 0 else rng.randrange(40) / 40) for i in range(n)]


def test_auc_and_precision_against_loops(spark):
    rows = tied_rows(1)
    got = metrics.classification_metrics(frame(spark, rows)).first()
    positive = [p for y, p in rows if y]
    negative = [p for y, p in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in positive for b in negative)
    assert math.isclose(got["AUC"], pairs / len(positive) / len(negative))
    precision, recall_before = 0.0, 0.0
    for score in sorted({p for _, p in rows}, reverse=True):
        tp = sum(1 for y, p in rows if y and p >= score)
        recall = tp / len(positive)
        precision += (recall - recall_before) * tp / sum(1 for _, p in rows if p >= score)
        recall_before = recall
    assert math.isclose(got["PR"], precision)
    assert math.isclose(got["Brier"], np.mean([(p - y) ** 2 for y, p in rows]))
    assert got["n"] == len(rows)


def test_perfect_and_useless_ranking(spark):
    assert metrics.roc_auc(frame(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])).first()["AUC"] == 1.0
    assert metrics.roc_auc(frame(spark, [(0, 0.4), (1, 0.4)])).first()["AUC"] == 0.5
    one_class = metrics.classification_metrics(frame(spark, [(0, 0.4), (0, 0.6)])).first()
    assert one_class["AUC"] is None and one_class["PR"] is None


def test_roc_curve_ends(spark):
    points = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(frame(spark, tied_rows(2))).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert all(a[1] <= b[1] for a, b in zip(points, points[1:]))


def plain_gini(rows, order):
    ranked = sorted(range(len(rows)), key=lambda i: (-order(rows[i]), i))
    losses = np.array([rows[i][0] for i in ranked], dtype=float)
    return (losses.cumsum().sum() / losses.sum() - (len(rows) + 1) / 2) / len(rows)


@pytest.mark.parametrize("partitions", [1, 9])
def test_gini_with_a_hot_score(spark, partitions):
    rng = random.Random(3)
    rows = [(rng.random() * 100, 5.0 if i % 2 else rng.random() * 10) for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = metrics.normalized_gini(frame(spark, rows)).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert math.isclose(got["gini_pred"], plain_gini(rows, lambda r: r[1]), abs_tol=1e-12)
    assert math.isclose(got["gini_perfect"], plain_gini(rows, lambda r: r[0]), abs_tol=1e-12)


def test_gini_limits(spark):
    perfect = frame(spark, [(y, y) for y in (1, 5, 9, 2)])
    assert math.isclose(metrics.normalized_gini(perfect).first()["NormGini"], 1.0)
    assert metrics.normalized_gini(frame(spark, [(0, 1), (0, 2)])).first()["NormGini"] == 0.0


def test_regression_metrics(spark):
    rows = [(1, 2), (2, 2), (4, 3)]
    got = metrics.regression_metrics(frame(spark, rows)).first()
    assert math.isclose(got["MAE"], 2 / 3) and math.isclose(got["RMSE"], math.sqrt(2 / 3))
    assert math.isclose(got["R2"], 1 - 2 / (14 / 3))
    assert metrics.regression_metrics(frame(spark, [(1, 1), (1, 2)])).first()["R2"] is None


def test_trend(spark):
    got = metrics.ols_trend(frame(spark, [(1, 3), (2, 5), (3, 7)])).first()
    assert math.isclose(got["slope"], 2) and math.isclose(got["intercept"], 1) and math.isclose(got["r2"], 1)
    assert metrics.ols_trend(frame(spark, [(1, 3), (1, 5)])).first()["slope"] is None


def test_bootstrap(spark):
    df = frame(spark, tied_rows(4, 120))
    row = metrics.bootstrap_interval(df, "AUC", replicates=40).first()
    auc = metrics.roc_auc(df).first()["AUC"]
    assert row["used"] == 40 and row["lower"] < auc < row["upper"]
    again = metrics.bootstrap_interval(df.repartition(7), "AUC", replicates=40).first()
    assert again == row  # draws depend on the row, not on its place
    few = metrics.bootstrap_interval(frame(spark, [(0, 0.1), (1, 0.2)]), "Brier", replicates=5).first()
    assert few["lower"] is None and few["used"] == 0


def drawn(n, replicates, seed):
    """The weights of rows named 0, 1, 2, …, number by number: each from its own hash of row and replicate."""
    out = np.zeros((n, replicates), int)
    for row in range(n):
        for k in range(1, replicates + 1):
            digits = hashlib.md5(f"{row}|{k}|{seed}".encode()).hexdigest()[:13]
            out[row, k - 1] = sum((int(digits, 16) + 0.5) / 16**13 >= step for step in metrics._poisson_steps())
    return out


def test_resample_weights_are_poisson():
    w = drawn(3000, 8, 1)
    assert (metrics.resample_weights([str(i) for i in range(3000)], 8, 1) == w).all()
    assert np.abs(w.mean(axis=0) - 1).max() < 0.07 and np.abs(w.var(axis=0) - 1).max() < 0.15
    # replicates, and neighbouring rows, are drawn apart
    assert np.abs(np.corrcoef(w.T) - np.eye(8)).max() < 0.08
    assert abs(np.corrcoef(w[:-1].ravel(), w[1:].ravel())[0, 1]) < 0.03


@pytest.mark.parametrize("ties", [True, False])
def test_bootstrap_against_loops(spark, ties):
    rng = random.Random(9)
    rows = tied_rows(5, 150) if ties else [(int(rng.random() < 0.4), rng.random()) for _ in range(150)]
    df = frame(spark, rows)
    weights = drawn(len(rows), 6, 42)
    got = {m: {r["replicate"]: r["value"] for r in metrics.bootstrap_metric(df, m, 6).collect()} for m in ("AUC", "PR", "MAE")}
    for k in range(6):
        w = weights[:, k]
        positive = [(p, n) for (y, p), n in zip(rows, w) if y]
        negative = [(p, n) for (y, p), n in zip(rows, w) if not y]
        pairs = sum(n * m * ((a > b) + 0.5 * (a == b)) for a, n in positive for b, m in negative)
        total = sum(n for _, n in positive)
        assert math.isclose(got["AUC"][k + 1], pairs / total / sum(n for _, n in negative))
        precision = 0.0
        for score in {p for p, _ in positive}:
            tp = sum(n for p, n in positive if p >= score)
            here = sum(n for p, n in positive if p == score)
            if here:
                precision += here * tp / (tp + sum(n for p, n in negative if p >= score))
        assert math.isclose(got["PR"][k + 1], precision / total)
        assert math.isclose(got["MAE"][k + 1], sum(n * abs(y - p) for (y, p), n in zip(rows, w)) / w.sum())


def test_missing_and_infinite_figures(spark):
    rows = [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.4)]
    known = frame(spark, rows)
    gaps = spark.createDataFrame([(90, 0.0, None), (91, 1.0, math.nan), (92, None, 0.5)], SCHEMA)
    both = known.unionByName(gaps)
    assert metrics.classification_metrics(both).first() == metrics.classification_metrics(known).first()
    assert metrics.regression_metrics(both).first() == metrics.regression_metrics(known).first()
    values = [1.0, 2.0, math.nan, None, math.inf, -math.inf, 3.0, 2.5]
    column = spark.createDataFrame([(v,) for v in values], "x double")
    found = distribution.describe(column, ["x"]).first()
    assert found["q50"] == np.quantile([1, 2, math.inf, -math.inf, 3, 2.5], 0.5)
    infinite = spark.createDataFrame([(math.inf,)] * 3, "x double")
    assert distribution.describe(infinite, ["x"]).first()["q50"] == math.inf


def test_calibration_bins(spark):
    rows = [(0, 0.0), (1, 0.1), (1, 0.100001), (0, 1.0)]
    got = {r["bin"]: r["n"] for r in metrics.calibration_table(frame(spark, rows)).collect()}
    assert got == {1: 2, 2: 1, 10: 1}  # right-closed; the minimum falls into the first
    constant = metrics.calibration_table(frame(spark, [(0, 0.4), (1, 0.4)])).collect()
    assert [(r["bin"], r["n"]) for r in constant] == [(1, 2)]


def test_class_weights(spark):
    got = metrics.class_weights(frame(spark, [(1, 0)] + [(0, 0)] * 3)).first()
    assert (got["weight_positive"], got["scale_pos_weight"]) == (2.0, 3.0)
    assert metrics.class_weights(frame(spark, [(0, 0)])).first()["scale_pos_weight"] == 1.0


def test_premium_kpis(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 9.0)], "driver_id string, premium double")
    got = monitoring.premium_kpis(df).first()
    assert (got["drivers"], got["mean_premium"], got["high_risk"]) == (4, 3.75, 1)


def test_best_models_and_defaults(spark):
    schema = "Model string, AUC double, MAE double, artifact string"
    summary = spark.createDataFrame(
        [("Frequency — A", 0.6, None, "fa"), ("Frequency — B", 0.7, None, "fb"), ("Frequency — C", None, None, "fc"),
         ("Severity — A", None, 9.0, "sa"), ("Severity — B", None, 7.0, "sb")], schema)
    assert tuple(monitoring.best_models(summary).first()) == ("fb", "sb")
    assert tuple(monitoring.best_models(summary.filter("Model = 'Severity — A'")).first()) == ("frequency_rf", "sa")
    assert tuple(monitoring.best_models(summary.limit(0)).first()) == ("frequency_rf", "severity_xgb")


def test_claim_kpis_without_amount(spark):
    df = spark.createDataFrame([(True, 10.0), (False, 0.0)], "claim_occurred boolean, claim_amount double")
    assert tuple(monitoring.claim_kpis(df).first()) == (2, 0.5, 1, 10.0)
    assert monitoring.claim_kpis(df.drop("claim_amount")).first()["mean_severity"] is None


def test_counters_are_zero_filled(spark):
    df = spark.createDataFrame([("ACCEPTED",), ("ACCEPTED",), ("REJECTED",)], "outcome string")
    got = {r["counter"]: r["n"] for r in monitoring.outcome_counters(df).collect()}
    assert got == {"accepted": 2, "rejected": 1, "unauth": 0, "duplicates": 0, "rate_limited": 0}


def test_scores_clip_and_multiply(spark):
    df = spark.createDataFrame([("a", 1.2, -5.0), ("b", 0.5, 100.0), ("c", None, 3.0)], "driver_id string, p_raw double, severity_raw double")
    got = {r["driver_id"]: r for r in labels.with_premium(labels.with_expected_loss(labels.clip_scores(df))).collect()}
    assert got["a"]["expected_loss"] == 0.0 and got["b"]["expected_loss"] == 50.0
    assert math.isclose(got["b"]["premium"], 67.5) and got["c"]["premium"] is None
    with pytest.raises(ValueError, match="expected_loss"):
        labels.with_premium(df)
