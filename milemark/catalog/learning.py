"""Queries for the models: fitted on the training set derived from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.registry import CTES, FEATURE_NAMES, gold, query, r, rounded, sql_uniform, training, training_table, with_ctes
from milemark.models import scoring
from milemark.models.estimators import SPECS, SPECS_BY_NAME
from milemark.models.frames import frequency_frame, severity_frame
from milemark.operators import labels, metrics, monitoring
from milemark.plans import learning
from milemark.schemas import MODEL_SUMMARY, conform
from milemark.session import scratch_path, store
from milemark.sources import readers, writers


# The sides of the models as SQL: whole drivers by hash; if a side lacks a class, both sides are all rows.
_USABLE = """count(*) >= 10 AND count(*) FILTER (t AND positive) > 0 AND count(*) FILTER (t AND NOT positive) > 0
  AND count(*) FILTER (NOT t AND positive) > 0 AND count(*) FILTER (NOT t AND NOT positive) > 0"""
CTES["frequency_rows"] = (
    ["training"],
    f"""SELECT driver_id, claim_occurred::int::double AS label, claim_occurred AS positive,
          {sql_uniform('driver_id', labels.SEED, 'split')} < 0.2::double AS t FROM training""",
)
CTES["severity_rows"] = (
    ["training"],
    f"""SELECT driver_id, claim_amount AS label, claim_amount > (SELECT avg(claim_amount) FROM training WHERE claim_occurred)
          AS positive, {sql_uniform('driver_id', labels.SEED, 'split')} < 0.2::double AS t
        FROM training WHERE claim_occurred""",
)
for _side in ("frequency", "severity"):
    CTES[f"{_side}_test"] = (
        [f"{_side}_rows"],
        f"SELECT * FROM {_side}_rows WHERE t OR NOT (SELECT {_USABLE} FROM {_side}_rows)",
    )


def _side(spec) -> str:
    return f"{spec.kind.lower()}_test"


def _frame(spec, data):
    make = frequency_frame if spec.kind == "Frequency" else severity_frame
    return make(data)


def _checked(predictions, kind: str):
    """Driver, outcome, and whether the prediction is one: a probability, or an amount that is not negative."""
    p = F.col("y_pred")
    fits = p.between(0, 1) if kind == "Frequency" else (p >= 0) & (p < float("inf"))
    return predictions.select("driver_id", F.round("y_true", 4).alias("y_true"), F.coalesce(fits, F.lit(False)).alias("fits"))


def _checked_sql(spec) -> str:
    return with_ctes(f"SELECT driver_id, {r('label', 4)} AS y_true, true AS fits FROM {_side(spec)}", _side(spec))


def _model_query(name: str, model: str) -> None:
    spec = SPECS_BY_NAME[model]

    @query(name, _checked_sql(spec))
    def fit_and_predict(spark, sf):
        """Test predictions of the model: which drivers, with which outcome, and whether each is a prediction."""
        frame = _frame(spec, training_table(spark, sf))
        return _checked(scoring.predict(spec.fit(frame).model, frame.test, spec.kind), spec.kind)


_model_query("ml2_logistic_regression", "frequency_logit")
_model_query("ml3_random_forest", "frequency_rf")
_model_query("ml4_boosted_classifier", "frequency_xgb")
_model_query("ml5_linear_regression", "severity_linreg")
_model_query("ml6_boosted_regressor", "severity_xgb")
_model_query("ml7_gamma_glm", "severity_gamma_glm")


@query(
    "ml8_calibration",
    with_ctes(
        f"""SELECT count(*) AS n, {r('avg(label)')} AS mean_true, true AS fits,
              CASE WHEN (SELECT count(*) FROM frequency_rows) - count(*) >= 50 THEN 'isotonic_cv3' ELSE 'sigmoid_prefit' END
              AS calibration FROM frequency_test""",
        "frequency_test",
    ),
)
def ml8(spark, sf):
    """Calibration bins of the logistic model, summed up again."""
    frame = frequency_frame(training_table(spark, sf))
    fitted = SPECS_BY_NAME["frequency_logit"].fit(frame)
    predictions = scoring.predict(fitted.model, frame.test, "Frequency")
    bins = metrics.calibration_table(store(predictions, "calibrated"))
    return bins.agg(
        F.sum("n").alias("n"),
        F.round(F.sum(F.col("mean_true") * F.col("n")) / F.sum("n"), 6).alias("mean_true"),
        F.min(F.col("mean_pred").between(0, 1) & F.col("bin").between(1, 10)).alias("fits"),
        F.lit(fitted.calibration).alias("calibration"),
    )


@query(
    "ml9_evaluation",
    with_ctes(
        f"""SELECT '{SPECS_BY_NAME['frequency_logit'].title}' AS "Model", (SELECT count(*) FROM frequency_test) AS n_test,
              (SELECT {_USABLE} FROM frequency_rows) AS was_split, true AS in_interval
            UNION ALL SELECT '{SPECS_BY_NAME['severity_linreg'].title}', (SELECT count(*) FROM severity_test),
              (SELECT {_USABLE} FROM severity_rows), true""",
        "frequency_test", "severity_test",
    ),
)
def ml9(spark, sf):
    """Metrics with intervals of a frequency and a severity model, side by side; each metric lies in its interval."""
    rows, data = [], training_table(spark, sf)
    for model, bounded in (("frequency_logit", ["AUC", "PR"]), ("severity_linreg", ["MAE"])):
        spec = SPECS_BY_NAME[model]
        row = learning.train_one(spec, _frame(spec, data), intervals=True).metrics
        inside = [F.col(m).between(F.col(f"{m}_CI_low"), F.col(f"{m}_CI_high")) for m in bounded]
        rows.append(row.withColumn("in_interval", reduce(lambda a, b: a & b, inside)))
    return metrics.compare_models(rows).select("Model", "n_test", "was_split", "in_interval")


# A model without any random or iterative part can be checked exactly: the straight line through one
# feature, fitted by MLlib, is the regression slope of the summed squares.
@query(
    "ml5_single_feature_line",
    with_ctes(
        f"""SELECT row_id, {r('y_true', 4)} AS y_true, {r('a + b * x', 4)} AS y_pred FROM
              (SELECT row_id, y_true, y_pred / 1000 AS x FROM reg_preds),
              (SELECT regr_slope(y_true, y_pred / 1000) AS b, regr_intercept(y_true, y_pred / 1000) AS a FROM reg_preds)""",
        "reg_preds",
    ),
)
def ml5_line(spark, sf):
    from milemark.models.estimators import fit_linear
    from milemark.models.frames import ModelFrame

    rows = inputs.reg_preds(spark, sf).select(
        F.col("row_id").cast("string").alias("driver_id"), "row_id", F.col("y_true").alias("label"),
        (F.col("y_pred") / 1000).alias("x"),
    )
    frame = ModelFrame(rows, rows, ["x"], False)
    predicted = fit_linear(frame).model.transform(rows)
    return rounded(predicted.select("row_id", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred")), 4)


@query("ml10_saved_model", with_ctes("SELECT driver_id, true AS same FROM severity_test", "severity_test"))
def ml10(spark, sf):
    """A model saved, found by its registry entry, loaded and applied again: as the stored predictions."""
    from pyspark.ml import PipelineModel

    base = scratch_path(spark, "ml10")
    spec = SPECS_BY_NAME["severity_linreg"]
    data = training_table(spark, sf)
    learning.train_models(
        data, f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry", [spec]
    )
    entry = monitoring.latest_per_model(readers.read_registry(spark, f"{base}/registry"))
    model = PipelineModel.load(entry.first()["artifact"])
    again = scoring.predict(model, severity_frame(data).test, spec.kind)
    stored = readers.read_table(spark, f"{base}/predictions/{spec.name}").select("driver_id", F.col("y_pred").alias("stored"))
    near = F.abs(F.col("y_pred") - F.col("stored")) <= 1e-9 * (1 + F.abs("stored"))
    return again.join(stored, "driver_id", "full_outer").select("driver_id", F.coalesce(near, F.lit(False)).alias("same"))


_METRIC_ROWS = " UNION ALL ".join(
    f"""SELECT '{spec.title}' AS "Model", {str(spec.kind == 'Frequency').lower()} AS has_auc,
      {str(spec.kind == 'Severity').lower()} AS has_mae, (SELECT count(*) FROM {_side(spec)}) AS n_test, true AS as_stored,
      (SELECT {_USABLE} FROM {spec.kind.lower()}_rows) AS was_split"""
    for spec in SPECS
)


@query("ml11_all_models", with_ctes(_METRIC_ROWS, "frequency_test", "severity_test"))
def ml11(spark, sf):
    """All six models, one summary row each; the metrics are those of the stored predictions."""
    base = scratch_path(spark, "ml11")
    learning.train_models(
        training(spark, sf), f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry", SPECS
    )
    again = []
    for spec in SPECS:
        row = learning.evaluate(readers.read_table(spark, f"{base}/predictions/{spec.name}"), spec.kind)
        again.append(row.select(F.lit(spec.title).alias("Model"), "n_test", F.col("AUC" if spec.kind == "Frequency" else "MAE").alias("again")))
    summary = readers.read_model_summary(spark, f"{base}/summary")
    metric = F.coalesce("AUC", "MAE")
    return summary.join(metrics.compare_models(again), "Model").select(
        "Model", F.col("AUC").isNotNull().alias("has_auc"), F.col("MAE").isNotNull().alias("has_mae"), "n_test",
        (F.abs(metric - F.col("again")) <= 1e-9 * (1 + F.abs(metric))).alias("as_stored"), "was_split",
    )


@query(
    "jb6_train_models",
    " UNION ALL ".join(
        f"SELECT '{spec.name}' AS name, 'v7' AS version, 'train' AS phase, true AS hashed, 1 AS metric_rows"
        for spec in SPECS if spec.name in ("frequency_logit", "severity_gamma_glm")
    ),
)
def jb6(spark, sf):
    """The training job's registry entries, each with the metric file it names."""
    base = scratch_path(spark, "jb6")
    learning.train_models(
        training(spark, sf), f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry",
        [SPECS_BY_NAME["frequency_logit"], SPECS_BY_NAME["severity_gamma_glm"]], version="v7",
    )
    entries = readers.read_registry(spark, f"{base}/registry")
    written = spark.read.json(f"{base}/predictions/*_metrics").groupBy(F.col("name").alias("of")).agg(F.count(F.lit(1)).alias("metric_rows"))
    return entries.join(written, entries["name"] == written["of"]).select(
        "name", "version", "phase", (F.length("data_hash") == 16).alias("hashed"), "metric_rows"
    )


def _trained_pair(spark, sf, base):
    data = training(spark, sf)
    data.write.parquet(f"{base}/training")
    learning.train_models(
        readers.read_table(spark, f"{base}/training"),
        f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry",
        [SPECS_BY_NAME["frequency_logit"], SPECS_BY_NAME["severity_linreg"], SPECS_BY_NAME["severity_gamma_glm"]],
    )


def _checked_scores(scores):
    p, amount, loss = F.col("p_claim_30d"), F.col("severity_pred"), F.col("expected_loss")
    return scores.select(
        "driver_id", F.round("total_km", 6).alias("total_km"), (p.between(0, 1) & (amount >= 0)).alias("fits"),
        (F.abs(loss - p * amount) <= 1e-9 * (1 + F.abs(loss))).alias("is_product"),
    )


_SCORES_SQL = with_ctes(f"SELECT driver_id, {r('total_km')} AS total_km, true AS fits, true AS is_product FROM training", "training")


@query("ml12_risk_scores", _SCORES_SQL)
def ml12(spark, sf):
    """Every driver scored with the best pair of the summary."""
    base = scratch_path(spark, "ml12")
    _trained_pair(spark, sf, base)
    return _checked_scores(learning.score_drivers(spark, f"{base}/training", f"{base}/summary", f"{base}/scores"))


@query(
    "jb7_default_pair",
    with_ctes(
        "SELECT count(*) AS rows, count(DISTINCT driver_id) AS drivers, 'frequency_rf' AS frequency, 'severity_xgb' AS severity FROM training",
        "training",
    ),
)
def jb7(spark, sf):
    """Without a summary the default models score; the manifest names them."""
    base = scratch_path(spark, "jb7")
    training(spark, sf).write.parquet(f"{base}/training")
    data = readers.read_table(spark, f"{base}/training")
    frames = {"Frequency": frequency_frame(data), "Severity": severity_frame(data)}
    for name in (monitoring.DEFAULT_FREQUENCY_MODEL, monitoring.DEFAULT_SEVERITY_MODEL):
        spec = SPECS_BY_NAME[name]
        spec.fit(frames[spec.kind]).model.write().overwrite().save(f"{base}/models/{name}")
    learning.score_drivers(
        spark, f"{base}/training", f"{base}/none", f"{base}/scores", f"{base}/preview", f"{base}/manifests", f"{base}/models"
    )
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    return readers.read_json_documents(spark, f"{base}/manifests").select(
        "rows", "drivers", last("frequency_model").alias("frequency"), last("severity_model").alias("severity")
    )


@query(
    "ml13_feature_weights",
    " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{feature}' AS feature, '{kind}' AS kind, true AS fits"
        for model, kind in (("severity_linreg", "coefficient"), ("frequency_rf", "importance"))
        for feature in FEATURE_NAMES
    ),
)
def ml13(spark, sf):
    """Coefficients of a linear and importances of a tree model; importances sum to 1."""
    rows, data = [], training_table(spark, sf)
    for model in ("severity_linreg", "frequency_rf"):
        spec = SPECS_BY_NAME[model]
        frame = _frame(spec, data)
        weights = scoring.feature_weights(spec.fit(frame).model, frame.features, spark)
        total = weights.agg(F.sum("weight")).scalar()
        whole = (F.col("kind") != "importance") | ((F.col("weight") >= 0) & (F.abs(total - 1) < 1e-6))
        rows.append(weights.select(F.lit(model).alias("model"), "feature", "kind", (whole & ~F.isnan("weight")).alias("fits")))
    return metrics.compare_models(rows)


@query("ml14_stored_predictions", _checked_sql(SPECS_BY_NAME["severity_gamma_glm"]))
def ml14(spark, sf):
    """Predictions as the training job writes them."""
    base = scratch_path(spark, "ml14")
    learning.train_models(
        training(spark, sf), f"{base}/models", f"{base}/predictions", f"{base}/summary", f"{base}/registry",
        [SPECS_BY_NAME["severity_gamma_glm"]],
    )
    return _checked(readers.read_table(spark, f"{base}/predictions/severity_gamma_glm"), "Severity")


@query(
    "jn4_scores_by_driver",
    with_ctes(
        f"""SELECT driver_id, {r('CASE WHEN p_raw IS NOT NULL THEN least(greatest(p_raw, 0), 1) END')} AS p_claim_30d,
              {r('CASE WHEN severity_raw IS NOT NULL THEN greatest(severity_raw, 0) END')} AS severity_pred,
              {r('CASE WHEN p_raw + severity_raw IS NOT NULL THEN least(greatest(p_raw, 0), 1) * greatest(severity_raw, 0) END')} AS expected_loss,
              {r('total_km')} AS total_km
            FROM (SELECT driver_id, CASE WHEN severity_raw > 0 THEN p_raw END AS p_raw,
                CASE WHEN p_raw > 0.1 THEN severity_raw END AS severity_raw FROM risk_in
              WHERE severity_raw > 0 OR p_raw > 0.1) LEFT JOIN km USING (driver_id)""",
        "risk_in", "km",
    ),
)
def jn4(spark, sf):
    raw = inputs.risk_in(spark, sf)
    # some drivers are missing on either side
    p = raw.filter("severity_raw > 0").select("driver_id", F.col("p_raw").alias("y_pred"))
    severity = raw.filter("p_raw > 0.1").select("driver_id", F.col("severity_raw").alias("y_pred"))
    return rounded(scoring.join_scores(p, severity, gold(spark, sf)))


# Six scorers evaluated on the given tables stand for the six models of a summary.
_SCORERS = [
    ("Frequency — Logistic Regression", "frequency_logit", "y_pred"),
    ("Frequency — Random Forest", "frequency_rf", "1 - y_pred"),
    ("Frequency — Boosted Trees", "frequency_xgb", "abs(y_pred - 0.5)"),
    ("Severity — Linear Regression", "severity_linreg", "y_pred"),
    ("Severity — Boosted Trees", "severity_xgb", "y_pred * 0.9"),
    ("Severity — Gamma GLM", "severity_gamma_glm", "y_pred * 1.1"),
]


def scorer_summary(spark, sf):
    """A model summary measured on the given tables."""
    rows = []
    for title, artifact, expression in _SCORERS:
        if title.startswith("Frequency"):
            preds = inputs.class_preds(spark, sf).withColumn("y_pred", F.expr(expression))
            row = metrics.classification_metrics(preds).select(*[F.round(c, 6).alias(c) for c in ("AUC", "PR", "Brier")])
        else:
            preds = inputs.reg_preds(spark, sf).withColumn("y_pred", F.expr(expression))
            row = metrics.regression_metrics(preds).select(
                F.round("MAE", 4).alias("MAE"), F.round("RMSE", 4).alias("RMSE"), F.round("R2", 6).alias("R2")
            )
        rows.append(row.withColumns({"Model": F.lit(title), "artifact": F.lit(artifact)}))
    return conform(metrics.compare_models(rows), MODEL_SUMMARY)


def _scorer_sql() -> str:
    parts = []
    for title, artifact, expression in _SCORERS:
        expression = expression.replace("0.5", "0.5::double").replace("0.9", "0.9::double").replace("1.1", "1.1::double")
        if title.startswith("Frequency"):
            parts.append(
                f"""SELECT '{title}' AS "Model", '{artifact}' AS artifact,
                  {r('sum(fp * (tp_cum - tp / 2.0::double)) / max(tp_total) / max(fp_total)')} AS "AUC",
                  {r('sum(tp * (tp_cum / (tp_cum + fp_cum))) / max(tp_total)')} AS "PR",
                  {r('sum(tp * (s - 1) * (s - 1) + fp * s * s) / sum(tp + fp)')} AS "Brier",
                  NULL::double AS "MAE", NULL::double AS "RMSE", NULL::double AS "R2"
                FROM (SELECT *, sum(tp) OVER (ORDER BY s DESC) AS tp_cum, sum(fp) OVER (ORDER BY s DESC) AS fp_cum,
                    sum(tp) OVER () AS tp_total, sum(fp) OVER () AS fp_total
                  FROM (SELECT {expression} AS s, count(*) FILTER (y_true > 0) AS tp,
                      count(*) FILTER (NOT y_true > 0) AS fp FROM class_preds GROUP BY s))"""
            )
        else:
            error = f"(y_true - {expression})"
            parts.append(
                f"""SELECT '{title}', '{artifact}', NULL, NULL, NULL, {r(f'avg(abs({error}))', 4)},
                  {r(f'sqrt(avg({error} * {error}))', 4)}, {r(f'1 - avg({error} * {error}) / var_pop(y_true)')}
                FROM reg_preds"""
            )
    return " UNION ALL ".join(parts)


_SUMMARY_CTE = _scorer_sql()


@query(
    "wn7_best_models",
    with_ctes(
        f"""SELECT (SELECT artifact FROM s WHERE "Model" LIKE '%Frequency%' ORDER BY "AUC" DESC NULLS LAST, "Model" LIMIT 1)
              AS frequency_artifact,
            (SELECT artifact FROM s WHERE "Model" LIKE '%Severity%' ORDER BY "MAE" NULLS LAST, "Model" LIMIT 1)
              AS severity_artifact""",
        "class_preds", "reg_preds",
    ).replace("\nSELECT (SELECT", f",\ns AS MATERIALIZED ({_SUMMARY_CTE})\nSELECT (SELECT"),
)
def wn7(spark, sf):
    return monitoring.best_models(scorer_summary(spark, sf))


@query(
    "or2_models_by_metric",
    with_ctes(
        f"""SELECT "Model", "AUC", CASE WHEN "AUC" IS NOT NULL THEN rank() OVER (ORDER BY "AUC" DESC NULLS LAST) END AS place
            FROM ({_SUMMARY_CTE})""",
        "class_preds", "reg_preds",
    ),
)
def or2(spark, sf):
    return monitoring.models_by_metric(scorer_summary(spark, sf), "AUC", descending=True).select("Model", "AUC", "place")


@query(
    "src7_model_summary_csv",
    with_ctes(
        f"""SELECT "Model", artifact, "AUC", "PR", "Brier", "MAE", "RMSE", "R2" FROM ({_SUMMARY_CTE})""",
        "class_preds", "reg_preds",
    ),
)
def src7(spark, sf):
    path = scratch_path(spark, "summary")
    writers.write_csv(scorer_summary(spark, sf), path)
    return readers.read_model_summary(spark, path).drop("config_hash", "run_time", "was_split")


@query(
    "wn8_latest_registry_entries",
    with_ctes(
        """SELECT name, version, data_hash, artifact, created_at FROM (SELECT *, row_number() OVER (
             PARTITION BY name ORDER BY created_at DESC, artifact DESC) AS place FROM registry_in) WHERE place = 1""",
        "registry_in",
    ),
)
def wn8(spark, sf):
    newest = monitoring.latest_per_model(inputs.registry_in(spark, sf), ["created_at", "artifact"])
    return newest.select("name", "version", "data_hash", "artifact", "created_at")


@query(
    "wn8_last_ten_entries",
    with_ctes(
        """SELECT name, version, created_at FROM registry_in ORDER BY created_at DESC, artifact DESC LIMIT 10""",
        "registry_in",
    ),
)
def wn8_last(spark, sf):
    last = monitoring.last_entries(inputs.registry_in(spark, sf), 10, ["created_at", "artifact"])
    return last.select("name", "version", "created_at")


@query(
    "src8_registry_json",
    with_ctes("SELECT name, count(*) AS n, max(created_at) AS latest FROM registry_in GROUP BY name", "registry_in"),
)
def src8(spark, sf):
    path = scratch_path(spark, "registry")
    inputs.registry_in(spark, sf).write.json(path)
    return readers.read_registry(spark, path).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest")
    )


_PRICED = "least(greatest(p_raw, 0), 1) * greatest(severity_raw, 0)"


@query(
    "jb8_priced_premiums",
    with_ctes(
        f"SELECT driver_id, {r(_PRICED)} AS expected_loss, {r(_PRICED + ' * 1.35::double')} AS premium FROM risk_in",
        "risk_in",
    ),
)
def jb8(spark, sf):
    base = scratch_path(spark, "jb8")
    scores = labels.with_expected_loss(labels.clip_scores(inputs.risk_in(spark, sf)))
    scores.write.parquet(f"{base}/scores")
    premiums = learning.price_premiums(spark, f"{base}/scores", f"{base}/premiums", f"{base}/manifests")
    return rounded(premiums.select("driver_id", "expected_loss", "premium"))
