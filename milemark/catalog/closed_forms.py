"""Models whose predictions have a closed form: fitted by the same functions on orders, checked value by value.

With one flag as the only feature, likelihood is highest at the rates or means of the two groups; with a label that is a
function of the feature, every leaf of a tree holds one value, whatever rows and features the tree drew.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from milemark.catalog.registry import query, r, rounded, sql_uniform
from milemark.models import scoring
from milemark.models.estimators import (
    BOOSTING, CALIBRATED, CALIBRATION_FOLDS, fit_boosted_classifier, fit_boosted_regressor, fit_forest, fit_gamma,
    fit_logistic,
)
from milemark.models.frames import ModelFrame
from milemark.operators.labels import SEED
from milemark.session import store
from milemark.sources.readers import read_table

_FLAG = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END"
_COSTLY = f"CASE WHEN o_totalprice > 300000 - 100000 * ({_FLAG}) THEN 1 ELSE 0 END"
_LEVEL = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"

_ORDERS = f"""orders_in AS (SELECT cast(o_orderkey AS VARCHAR) AS driver_id, {_FLAG} AS flag, {_LEVEL} AS level,
  {_COSTLY} AS costly, o_totalprice AS price FROM orders)"""


def _frame(spark, sf, label: str, feature: str) -> ModelFrame:
    """All orders on both sides."""
    orders = read_table(spark, f"{sf}/orders.parquet")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("driver_id"), F.col("o_orderkey").alias("row_id"),
        F.expr(label).cast("double").alias("label"), F.expr(feature).cast("double").alias("x"),
    )
    rows = store(rows.hint("rebalance"), "closed-form")
    return ModelFrame(rows, rows, ["x"], False)


@query(
    "ml2_rates_of_groups",
    f"""WITH {_ORDERS},
    sides AS (SELECT count(*) / (2.0 * sum(costly)) AS w1, count(*) / (2.0 * sum(1 - costly)) AS w0 FROM orders_in),
    groups AS (SELECT flag, sum(costly) AS pos, count(*) AS n FROM orders_in GROUP BY flag)
    SELECT driver_id, {r('w1 * pos / (w1 * pos + w0 * (n - pos))', 3)} AS p_balanced, {r('pos / n', 3)} AS p_calibrated
    FROM orders_in JOIN groups USING (flag), sides""",
)
def ml2_groups(spark, sf):
    """Without a penalty, the balanced model gives the weighted rate of a group, and the curve the plain rate."""
    frame = _frame(spark, sf, _COSTLY, _FLAG)
    model = fit_logistic(frame, inverse_penalty=1e9, min_calibration_rows=1 << 62).model
    found = model.transform(frame.test).select(
        "driver_id", vector_to_array("probability")[1].alias("p_balanced"),
        vector_to_array("probability_calibrated")[1].alias("p_calibrated"),
    )
    return rounded(found, 3)


@query(
    "ml8_isotonic_of_groups",
    f"""WITH {_ORDERS},
    folded AS (SELECT *, floor({sql_uniform('driver_id', SEED, 'fold')} * {CALIBRATION_FOLDS}) AS fold FROM orders_in),
    cells AS (SELECT flag, fold, sum(costly) AS pos, count(*) AS n FROM folded GROUP BY ALL),
    apart AS (
      SELECT *, sum(pos) OVER (PARTITION BY flag) - pos AS learn_pos, sum(n) OVER (PARTITION BY flag) - n AS learn_n,
        sum(pos) OVER (PARTITION BY fold) / sum(n) OVER (PARTITION BY fold) AS pooled FROM cells),
    -- where the fold orders the groups against the model, the curve is flat
    curves AS (
      SELECT a.flag, CASE WHEN (a.pos / a.n - b.pos / b.n) * (a.learn_pos / a.learn_n - b.learn_pos / b.learn_n) > 0
        THEN a.pos / a.n ELSE a.pooled END AS p
      FROM apart a JOIN apart b ON a.fold = b.fold AND a.flag <> b.flag),
    means AS (SELECT flag, avg(p) AS p FROM curves GROUP BY flag)
    SELECT driver_id, {r('p')} AS p_calibrated, 'isotonic_cv3' AS calibration FROM orders_in JOIN means USING (flag)""",
)
def ml8_groups(spark, sf):
    """The calibrated probability is the mean, over folds left out, of the rate of the group in the fold."""
    frame = _frame(spark, sf, _COSTLY, _FLAG)
    fitted = fit_logistic(frame)
    found = fitted.model.transform(frame.test).select("driver_id", F.col(CALIBRATED).alias("p_calibrated"))
    return rounded(found).withColumn("calibration", F.lit(fitted.calibration))


@query(
    "ml7_means_of_groups",
    f"""WITH {_ORDERS} SELECT driver_id, {r('avg(price) OVER (PARTITION BY flag) / 1000', 1)} AS thousands FROM orders_in""",
)
def ml7_groups(spark, sf):
    """Without a penalty, gamma regression on a flag gives the mean of the group."""
    frame = _frame(spark, sf, "o_totalprice", _FLAG)
    predicted = scoring.predict(fit_gamma(frame, penalty=0.0).model, frame.test, "Severity")
    return rounded(predicted.select("driver_id", (F.col("y_pred") / 1000).alias("thousands")), 1)


@query("ml3_pure_leaves", f"WITH {_ORDERS} SELECT driver_id, (level = 1)::int::double AS p FROM orders_in")
def ml3_leaves(spark, sf):
    """The middle of three levels is the positive class: every tree of the forest tells it apart."""
    frame = _frame(spark, sf, f"({_LEVEL}) = 1", _LEVEL)
    predicted = scoring.predict(fit_forest(frame).model, frame.test, "Frequency")
    return rounded(predicted.select("driver_id", F.col("y_pred").alias("p")))


# The first tree is the label itself (-1 or 1); each later one is the gradient of the loss at the margin so far.
@query(
    "ml4_margin_by_rounds",
    f"""WITH RECURSIVE {_ORDERS},
    rounds AS (
      SELECT 1 AS round, 1.0::double AS margin
      UNION ALL
      SELECT round + 1, margin + {BOOSTING['stepSize']} * 4 / (1 + exp(2 * margin)) FROM rounds WHERE round < {BOOSTING['maxIter']})
    SELECT driver_id, {r('1 / (1 + exp(CASE WHEN level = 1 THEN -2 ELSE 2 END * margin))')} AS p
    FROM orders_in, (SELECT max(margin) AS margin FROM rounds)""",
)
def ml4_rounds(spark, sf):
    """Boosted classifier on the same label: the margin grows by a known step in every round."""
    frame = _frame(spark, sf, f"({_LEVEL}) = 1", _LEVEL)
    predicted = scoring.predict(fit_boosted_classifier(frame).model, frame.test, "Frequency")
    return rounded(predicted.select("driver_id", F.col("y_pred").alias("p")))


@query(
    "ml6_amount_of_level",
    f"WITH {_ORDERS} SELECT driver_id, (1000 * (level - 1) * (level - 1) + 250 * level)::double AS amount FROM orders_in",
)
def ml6_levels(spark, sf):
    """Boosted regressor on amounts that depend on the level, not in its order."""
    amount = f"1000.0 * ({_LEVEL} - 1) * ({_LEVEL} - 1) + 250 * {_LEVEL}"
    frame = _frame(spark, sf, amount, _LEVEL)
    predicted = scoring.predict(fit_boosted_regressor(frame).model, frame.test, "Severity")
    return rounded(predicted.select("driver_id", F.col("y_pred").alias("amount")), 3)
