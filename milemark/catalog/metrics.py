"""Queries for model-quality metrics, on scores with many ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.registry import CTES, query, r, rounded, training, with_ctes
from milemark.operators import labels, metrics
from milemark.operators.metrics import _poisson_steps

# Running counts per distinct score, highest first.
SCORES = """SELECT y_pred, tp, fp, sum(tp) OVER w AS tp_cum, sum(fp) OVER w AS fp_cum,
    sum(tp) OVER () AS tp_total, sum(fp) OVER () AS fp_total
  FROM (SELECT y_pred, count(*) FILTER (y_true > 0) AS tp, count(*) FILTER (NOT y_true > 0) AS fp
    FROM class_preds GROUP BY y_pred)
  WINDOW w AS (ORDER BY y_pred DESC)"""
AUC = "sum(fp * (tp_cum - tp / 2.0::double)) / max(tp_total) / max(fp_total)"
PR = "sum(tp * (tp_cum / (tp_cum + fp_cum))) / max(tp_total)"


@query(
    "ag17_calibration_table",
    with_ctes(
        f"""SELECT bin, count(*) AS n, {r('avg(y_true)')} AS mean_true, {r('avg(y_pred)')} AS mean_pred FROM (
              SELECT *, least(greatest(cast(ceil((y_pred - lo) / ((hi - lo) / 10)) as bigint), 1), 10) AS bin
              FROM class_preds, (SELECT min(y_pred) AS lo, max(y_pred) AS hi FROM class_preds)) GROUP BY bin""",
        "class_preds",
    ),
)
def ag17(spark, sf):
    return rounded(metrics.calibration_table(inputs.class_preds(spark, sf)))


@query(
    "ag18_ols_trend",
    with_ctes(
        f"""SELECT {r('regr_slope(y_pred, y_true)')} AS slope, {r('regr_intercept(y_pred, y_true)', 4)} AS intercept,
            {r('regr_r2(y_pred, y_true)')} AS r2 FROM reg_preds""",
        "reg_preds",
    ),
)
def ag18(spark, sf):
    trend = metrics.ols_trend(inputs.reg_preds(spark, sf))
    return rounded(trend.withColumn("intercept", F.round("intercept", 4)))


@query(
    "ag19_regression_metrics",
    with_ctes(
        f"""SELECT count(*) AS n, {r('avg(abs(y_true - y_pred))', 4)} AS "MAE",
            {r('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', 4)} AS "RMSE",
            {r('1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true)')} AS "R2" FROM reg_preds""",
        "reg_preds",
    ),
)
def ag19(spark, sf):
    row = metrics.regression_metrics(inputs.reg_preds(spark, sf))
    return rounded(row.withColumns({"MAE": F.round("MAE", 4), "RMSE": F.round("RMSE", 4)}))


@query("ag20_roc_auc", with_ctes(f'SELECT {r(AUC, 9)} AS "AUC" FROM ({SCORES})', "class_preds"))
def ag20(spark, sf):
    return rounded(metrics.roc_auc(inputs.class_preds(spark, sf)), 9)


@query("ag21_average_precision", with_ctes(f'SELECT {r(PR, 9)} AS "PR" FROM ({SCORES})', "class_preds"))
def ag21(spark, sf):
    return rounded(metrics.average_precision(inputs.class_preds(spark, sf)), 9)


@query(
    "ag22_brier",
    with_ctes(f"SELECT {r('avg((y_pred - y_true) * (y_pred - y_true))', 9)} AS \"Brier\" FROM class_preds", "class_preds"),
)
def ag22(spark, sf):
    return rounded(metrics.brier_score(inputs.class_preds(spark, sf)), 9)


@query(
    "ag23_roc_curve",
    with_ctes(
        f"""SELECT y_pred AS threshold, {r('fp_cum / fp_total', 9)} AS fpr, {r('tp_cum / tp_total', 9)} AS tpr
            FROM ({SCORES}) UNION ALL SELECT NULL, 0, 0""",
        "class_preds",
    ),
)
def ag23(spark, sf):
    return rounded(metrics.roc_curve(inputs.class_preds(spark, sf)), 9)


def sql_gini(order: str) -> str:
    return f"""(SELECT CASE WHEN sum(y_true) = 0 THEN 0
        ELSE (sum(running) / sum(y_true) - (count(*) + 1) / 2.0::double) / count(*) END
      FROM (SELECT y_true, sum(y_true) OVER (ORDER BY {order} DESC, row_id ROWS UNBOUNDED PRECEDING) AS running
        FROM reg_preds))"""


@query("ag24_gini", with_ctes(f"SELECT {r(sql_gini('y_pred'), 8)} AS gini", "reg_preds"))
def ag24(spark, sf):
    return rounded(metrics.gini(inputs.reg_preds(spark, sf)), 8)


@query(
    "ag25_normalized_gini",
    with_ctes(
        f"""SELECT {r('a', 8)} AS gini_pred, {r('b', 8)} AS gini_perfect, {r('a / b', 8)} AS "NormGini"
            FROM (SELECT {sql_gini('y_pred')} AS a, {sql_gini('y_true')} AS b)""",
        "reg_preds",
    ),
)
def ag25(spark, sf):
    return rounded(metrics.normalized_gini(inputs.reg_preds(spark, sf)), 8)


# Many rows share one score: the order within the tie is by row id.
_COARSE = "(SELECT row_id, y_true, floor(y_pred / 100000) AS y_pred FROM reg_preds)"


@query(
    "ag24_gini_with_ties",
    with_ctes(f"SELECT {r(sql_gini('y_pred').replace('FROM reg_preds', 'FROM ' + _COARSE), 8)} AS gini", "reg_preds"),
)
def ag24_ties(spark, sf):
    coarse = inputs.reg_preds(spark, sf).withColumn("y_pred", F.floor(F.col("y_pred") / 100000))
    return rounded(metrics.gini(coarse), 8)


@query(
    "wn6_loss_concentration",
    with_ctes(
        f"""SELECT y_pred AS score, n, n_cum, {r('loss_cum / loss_total', 8)} AS loss_share FROM (
              SELECT y_pred, n, sum(n) OVER w AS n_cum, sum(loss) OVER w AS loss_cum, sum(loss) OVER () AS loss_total
              FROM (SELECT y_pred, count(*) AS n, sum(y_true) AS loss FROM {_COARSE} GROUP BY y_pred)
              WINDOW w AS (ORDER BY y_pred DESC))""",
        "reg_preds",
    ),
)
def wn6(spark, sf):
    coarse = inputs.reg_preds(spark, sf).withColumn("y_pred", F.floor(F.col("y_pred") / 100000))
    table = metrics.loss_concentration(coarse, "y_pred")
    return table.select(
        "score", "n", "n_cum", F.round(F.col("loss_cum") / F.col("loss_total"), 8).alias("loss_share")
    )


def _sql_weight(key: str) -> str:
    digest = f"md5(concat_ws('|', cast({key} as varchar), cast(replicate as varchar), '42'))"
    u = f"((cast(cast('0x' || substr({digest}, 1, 13) as bigint) as double) + 0.5) / 4503599627370496.0)"
    steps = " + ".join(f"(u >= {step!r}::double)::int" for step in _poisson_steps())
    return f"(SELECT *, {steps} AS w FROM (SELECT *, {u} AS u FROM class_preds, range(1, 201) t(replicate)))"


def sql_bootstrap(metric: str) -> str:
    value = AUC if metric == "AUC" else PR
    scores = f"""SELECT replicate, y_pred, tp, fp, sum(tp) OVER w AS tp_cum, sum(fp) OVER w AS fp_cum,
          sum(tp) OVER g AS tp_total, sum(fp) OVER g AS fp_total
        FROM (SELECT replicate, y_pred, sum(CASE WHEN y_true > 0 THEN w ELSE 0 END) AS tp,
                sum(CASE WHEN y_true > 0 THEN 0 ELSE w END) AS fp
              FROM {_sql_weight('row_id')} WHERE w > 0 GROUP BY replicate, y_pred)
        WINDOW w AS (PARTITION BY replicate ORDER BY y_pred DESC), g AS (PARTITION BY replicate)"""
    brier = f"""SELECT replicate, sum(w * (y_true - y_pred) * (y_true - y_pred)) / sum(w) AS value
        FROM {_sql_weight('row_id')} WHERE w > 0 GROUP BY replicate"""
    values = brier if metric == "Brier" else f"SELECT replicate, {value} AS value FROM ({scores}) GROUP BY replicate"
    return f"""SELECT '{metric}' AS metric, count(value) AS used, {r('quantile_cont(value, 0.025)', 8)} AS lower,
        {r('quantile_cont(value, 0.975)', 8)} AS upper FROM ({values})"""


def _bootstrap_query(name: str, metric: str) -> None:
    @query(name, with_ctes(sql_bootstrap(metric), "class_preds"))
    def bootstrap(spark, sf):
        return rounded(metrics.bootstrap_interval(inputs.class_preds(spark, sf), metric), 8)


CTES["continuous_preds"] = (
    ["reg_preds"],
    "SELECT row_id, (row_id % 7 < 2)::int::double AS y_true, y_pred FROM reg_preds ",
)


@query(
    "ag26_bootstrap_auc_continuous",
    with_ctes(sql_bootstrap("AUC").replace("class_preds", "continuous_preds"), "continuous_preds"),
)
def bootstrap_continuous(spark, sf):
    """Scores that hardly ever repeat."""
    rows = inputs.reg_preds(spark, sf).select("row_id", (F.col("row_id") % 7 < 2).cast("double").alias("y_true"), "y_pred")
    return rounded(metrics.bootstrap_interval(rows, "AUC"), 8)


_bootstrap_query("ag26_bootstrap_auc", "AUC")
_bootstrap_query("ag26_bootstrap_pr", "PR")
_bootstrap_query("ag26_bootstrap_brier", "Brier")


@query(
    "ag27_class_weights",
    with_ctes(
        f"""SELECT positives, negatives, {r('(positives + negatives) / (2 * positives)', 8)} AS weight_positive,
            {r('(positives + negatives) / (2 * negatives)', 8)} AS weight_negative,
            {r('coalesce(negatives / nullif(positives, 0), 1)', 8)} AS scale_pos_weight
            FROM (SELECT count(*) FILTER (y_true > 0) AS positives, count(*) FILTER (NOT y_true > 0) AS negatives
              FROM class_preds)""",
        "class_preds",
    ),
)
def ag27(spark, sf):
    return rounded(metrics.class_weights(inputs.class_preds(spark, sf)), 8)


@query(
    "jn5_models_side_by_side",
    with_ctes(
        f"""SELECT 'scorer a' AS "Model", count(*) AS n, {r('avg(abs(y_true - y_pred))', 4)} AS "MAE", NULL AS "Brier"
              FROM reg_preds
            UNION ALL SELECT 'scorer b', count(*), {r('avg(abs(y_true - y_pred / 2))', 4)}, NULL FROM reg_preds
            UNION ALL SELECT 'scorer c', count(*), NULL, {r('avg((y_pred - y_true) * (y_pred - y_true))', 6)}
              FROM class_preds""",
        "reg_preds", "class_preds",
    ),
)
def jn5(spark, sf):
    amounts, outcomes = inputs.reg_preds(spark, sf), inputs.class_preds(spark, sf)
    halved = amounts.withColumn("y_pred", F.col("y_pred") / 2)

    def named(rows, name, *columns):
        return rows.select(F.lit(name).alias("Model"), "n", *columns)

    brier = metrics.classification_metrics(outcomes).select("n", F.round("Brier", 6).alias("Brier"))
    mae = F.round("MAE", 4).alias("MAE")
    return metrics.compare_models(
        [
            named(metrics.regression_metrics(amounts), "scorer a", mae),
            named(metrics.regression_metrics(halved), "scorer b", mae),
            named(brier, "scorer c", "Brier"),
        ]
    )


@query(
    "ml1_grouped_split",
    with_ctes(
        """SELECT driver_id, claim_occurred, u < 0.2::double AS is_test FROM (SELECT *,
             ((cast(cast('0x' || substr(md5(concat_ws('|', driver_id, '42', 'split')), 1, 13) as bigint) as double)
               + 0.5) / 4503599627370496.0) AS u FROM training)""",
        "training",
    ),
)
def ml1(spark, sf):
    return labels.with_split(training(spark, sf)).select("driver_id", "claim_occurred", "is_test")


@query(
    "ml1_split_is_usable",
    with_ctes(
        """SELECT count(*) AS rows, count(*) FILTER (t AND claim_occurred) AS test_positives,
             count(*) FILTER (t AND NOT claim_occurred) AS test_negatives,
             count(*) FILTER (NOT t AND claim_occurred) AS train_positives,
             count(*) FILTER (NOT t AND NOT claim_occurred) AS train_negatives,
             count(*) >= 10 AND count(DISTINCT CASE WHEN t THEN claim_occurred END) = 2
               AND count(DISTINCT CASE WHEN NOT t THEN claim_occurred END) = 2 AS usable
           FROM (SELECT *, ((cast(cast('0x' || substr(md5(concat_ws('|', driver_id, '42', 'split')), 1, 13) as bigint)
             as double) + 0.5) / 4503599627370496.0) < 0.2::double AS t FROM training)""",
        "training",
    ),
)
def ml1_usable(spark, sf):
    return labels.split_is_usable(labels.with_split(training(spark, sf)), "claim_occurred")
