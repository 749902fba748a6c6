"""Quality metrics of predictions (y_true, y_pred), all as distributed aggregates."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milemark.operators.ordered import bucket_count, prefix_sums, ranged, value_edges, with_bucket
from milemark.schemas import null_if_nan

BOOTSTRAP_REPLICATES = 200
MIN_BOOTSTRAP_ROWS = 5


def scored(predictions: DataFrame) -> DataFrame:
    """The rows with a known outcome and a prediction; a missing one (null or NaN) is no score."""
    return predictions.filter(
        null_if_nan(F.col("y_true").cast("double")).isNotNull() & null_if_nan(F.col("y_pred").cast("double")).isNotNull()
    )


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """One row: n, MAE, RMSE, R2."""
    predictions = scored(predictions)
    y, error = F.col("y_true"), F.col("y_true") - F.col("y_pred")
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("R2"),
    )


def brier_score(predictions: DataFrame) -> DataFrame:
    gap = F.col("y_pred") - F.col("y_true")
    return scored(predictions).agg(F.avg(gap * gap).alias("Brier"))


def _score_table(
    predictions: DataFrame,
    by: list[str] = [],
    weight: Column | None = None,
) -> DataFrame:
    """Positives and negatives per distinct score, with running sums from the highest score down."""
    weight = F.lit(1) if weight is None else weight
    positive = F.col("y_true") > 0
    predictions = scored(predictions)
    counts = predictions.groupBy(*by, "y_pred").agg(
        F.sum(F.when(positive, weight).otherwise(0)).alias("tp"), F.sum(F.when(positive, 0).otherwise(weight)).alias("fp")
    )
    return prefix_sums(ranged(counts, [*by, "y_pred"], "scores"), "y_pred", ["tp", "fp"], by=by, descending=True)


def _auc() -> Column:
    """Aggregate over a score table: the trapezoid rule, ties counted half; null with one class only."""
    area = F.sum(F.col("fp") * (F.col("tp_cum") - F.col("tp") / 2))
    pairs = F.max("tp_total").cast("double") * F.max("fp_total")
    return F.try_divide(area, pairs)


def _average_precision() -> Column:
    """Aggregate over a score table: Σ (Rₙ − Rₙ₋₁)·Pₙ; null without positives."""
    precision = F.try_divide(F.col("tp_cum"), F.col("tp_cum") + F.col("fp_cum"))
    return F.try_divide(F.sum(F.col("tp") * precision), F.max("tp_total"))


def roc_auc(predictions: DataFrame) -> DataFrame:
    return _score_table(predictions).agg(_auc().alias("AUC"))


def average_precision(predictions: DataFrame) -> DataFrame:
    return _score_table(predictions).agg(_average_precision().alias("PR"))


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """One row: AUC, PR and Brier."""
    weighted_gap = (
        F.col("tp") * (F.col("y_pred") - 1) * (F.col("y_pred") - 1)
        + F.col("fp") * F.col("y_pred") * F.col("y_pred")
    )
    rows = F.col("tp") + F.col("fp")
    return _score_table(predictions).agg(
        F.sum(rows).alias("n"),
        _auc().alias("AUC"),
        _average_precision().alias("PR"),
        F.try_divide(F.sum(weighted_gap), F.sum(rows)).alias("Brier"),
    )


def roc_curve(predictions: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the origin at a null threshold."""
    points = _score_table(predictions).select(
        F.col("y_pred").alias("threshold"),
        F.try_divide(F.col("fp_cum"), F.col("fp_total")).alias("fpr"),
        F.try_divide(F.col("tp_cum"), F.col("tp_total")).alias("tpr"),
    )
    origin = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def loss_concentration(predictions: DataFrame, order: str, key: str = "row_id") -> DataFrame:
    """Per distinct ``order`` value, from the highest down: rows, losses and their running sums.

    ``inner`` sums, over the rows of one value in order of ``key``, the losses accumulated within
    that value. Rows of one very frequent value are split by ranges of the unique key: a range holds
    few rows whatever the value, because it holds few rows in all.
    """
    predictions = scored(predictions)
    edges = value_edges(predictions, [key])
    placed = predictions.select(
        F.col(order).alias("score"), F.col(key).alias("key"), F.col("y_true").alias("loss")
    )
    placed = with_bucket(placed, "key", edges[key], out="_range")
    in_range = Window.partitionBy("score", "_range").orderBy(F.col("key").desc())
    per_range = (
        placed.withColumn("_turns", F.row_number().over(in_range))
        .groupBy("score", "_range")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("loss").alias("loss"),
            F.sum(F.col("loss") * F.col("_turns")).alias("inner"),
        )
    )
    later = Window.partitionBy("score").orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_value = (
        per_range.withColumn("_rows_later", F.coalesce(F.sum("n").over(later), F.lit(0)))
        .groupBy("score")
        .agg(
            F.sum("n").alias("n"),
            F.sum("loss").alias("loss"),
            F.sum(F.col("inner") + F.col("loss") * F.col("_rows_later")).alias("inner"),
        )
    )
    return prefix_sums(ranged(per_value, ["score"], "losses"), "score", ["n", "loss"], descending=True)


def gini(predictions: DataFrame, order: str = "y_pred", key: str = "row_id") -> DataFrame:
    """One row: how well ``order`` concentrates the losses; 0 if there are none.

    The sum of running losses over all rows: those of a value contribute their own accumulation, and
    the losses of all higher values once per row.
    """
    table = loss_concentration(predictions, order, key)
    before = F.col("loss_cum") - F.col("loss")
    accumulated = F.sum(F.col("inner") + F.col("n") * before)
    n, total = F.max("n_total"), F.max("loss_total")
    value = F.when(total == 0, F.lit(0.0)).otherwise((accumulated / total - (n + 1) / 2) / n)
    return table.agg(value.alias("gini"))


def normalized_gini(predictions: DataFrame, key: str = "row_id") -> DataFrame:
    """Gini of the predictions over the Gini of a perfect order; 0 if that is 0."""
    sides = (
        gini(predictions, "y_pred", key)
        .withColumn("side", F.lit("pred"))
        .unionByName(gini(predictions, "y_true", key).withColumn("side", F.lit("perfect")))
    )
    both = sides.agg(
        F.max(F.when(F.col("side") == "pred", F.col("gini"))).alias("gini_pred"),
        F.max(F.when(F.col("side") == "perfect", F.col("gini"))).alias("gini_perfect"),
    )
    ratio = F.when(F.col("gini_perfect") == 0, F.lit(0.0)).otherwise(F.col("gini_pred") / F.col("gini_perfect"))
    return both.select("gini_pred", "gini_perfect", ratio.alias("NormGini"))


def _poisson_steps() -> list[float]:
    """Cumulative Poisson(1) probabilities, enough that the remaining tail is below one in 10^9."""
    steps, term = [], math.exp(-1.0)
    total, k = term, 0
    while total < 1 - 1e-9:
        steps.append(total)
        k += 1
        term /= k
        total += term
    return [*steps, total]


def resample_weights(keys: list[str | None], replicates: int, seed: int) -> np.ndarray:
    """How often each row is drawn in each replicate, rows by replicates: Poisson(1) from a hash of both."""
    tails = [f"{i}|{seed}".encode() for i in range(1, replicates + 1)]
    heads = [b"" if k is None else k.encode() + b"|" for k in keys]
    digests = b"".join([md5(head + tail).digest() for head in heads for tail in tails])
    number = np.frombuffer(digests, ">u8")[::2] >> 12  # the first 13 hexadecimal digits
    return np.searchsorted(_poisson_steps(), (number + 0.5) / 2.0**52, side="right").reshape(len(keys), replicates)


#: Rows whose weights are held at a time.
_CHUNK = 512


def _chunks(batches, replicates: int, seed: int):
    """(arrays of the columns but the key, weights) of a few rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(begin, _CHUNK)
            columns = {n: part.column(n).to_numpy(zero_copy_only=False) for n in part.schema.names if n != "_key"}
            yield columns, resample_weights(part.column("_key").to_pylist(), replicates, seed)


def _long_rows(names: list[str], bucket: int, *figures: np.ndarray) -> pa.RecordBatch:
    n = len(figures[0])
    columns = [np.full(n, bucket), np.arange(1, n + 1), *(np.asarray(f, float) for f in figures)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


_POINT_SCHEMA = "place long, replicate long, tp double, fp double, extra double"
_POINT = ["place", "replicate", "tp", "fp", "extra"]


def _placed(rows: DataFrame, edges: list[float]) -> DataFrame:
    """Add ``_place``: odd numbers are the open spans between edges, even ones the edges themselves, in order.

    A score that very many rows share is an edge, so a span never holds one.
    """
    placed = with_bucket(rows, "y_pred", edges)
    if not edges:
        return placed.withColumn("_place", F.lit(1)).drop("_bucket")
    at_edge = F.coalesce(F.get(F.array(*map(F.lit, edges)), F.col("_bucket") - 1) == F.col("y_pred"), F.lit(False))
    return placed.withColumn("_place", 2 * F.col("_bucket") + F.when(at_edge, 0).otherwise(1)).drop("_bucket")


def _place_sums(placed: DataFrame, replicates: int, seed: int) -> DataFrame:
    """(place, replicate, tp, fp): weights of positives and negatives, summed per task before any shuffle."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for c, w in _chunks(batches, replicates, seed):
            for place in np.unique(c["_place"]).tolist():
                here = c["_place"] == place
                sums = held.setdefault(place, np.zeros((2, replicates)))
                sums[0] += w[here & c["_positive"]].sum(axis=0)
                sums[1] += w[here & ~c["_positive"]].sum(axis=0)
        for place, sums in held.items():
            yield _long_rows(_POINT, place, *sums, np.zeros(replicates))

    return placed.mapInArrow(add, _POINT_SCHEMA).groupBy("place", "replicate").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))


def _span_sums(placed: DataFrame, replicates: int, seed: int, before: dict[int, np.ndarray] | None) -> DataFrame:
    """(place, replicate, extra) of the open spans: the area under the ROC curve inside the span alone, or with the
    weights ``before`` each span (tp and fp by replicate) the summed precision of its positives.

    Every row is shuffled once; a task sees the rows of a span from the highest score down.
    """
    shared = None if before is None else placed.sparkSession.sparkContext.broadcast(before)

    def add(batches):
        place, score = None, None
        group = total = extra = None

        def close_score():
            if shared is None:
                extra[:] += group[1] * (total[0] + group[0] / 2)
            else:
                tp, fp = total[0] + group[0] + shared.value[place][0], total[1] + group[1] + shared.value[place][1]
                extra[:] += np.divide(group[0] * tp, tp + fp, out=np.zeros(replicates), where=tp + fp > 0)
            total[:] += group

        for c, w in _chunks(batches, replicates, seed):
            new = np.flatnonzero((c["_place"][1:] != c["_place"][:-1]) | (c["y_pred"][1:] != c["y_pred"][:-1])) + 1
            for begin, end in zip([0, *new], [*new, len(w)], strict=True):
                if place != c["_place"][begin] or score != c["y_pred"][begin]:
                    if place is not None:
                        close_score()
                    if place != c["_place"][begin]:
                        if place is not None:
                            yield _long_rows(_POINT, place, *total, extra)
                        place, total, extra = int(c["_place"][begin]), np.zeros((2, replicates)), np.zeros(replicates)
                    score, group = c["y_pred"][begin], np.zeros((2, replicates))
                positive = c["_positive"][begin:end]
                group[0] += w[begin:end][positive].sum(axis=0)
                group[1] += w[begin:end][~positive].sum(axis=0)
        if place is not None:
            close_score()
            yield _long_rows(_POINT, place, *total, extra)

    spans = placed.filter("_place % 2 = 1").repartition("_place").sortWithinPartitions("_place", F.desc("y_pred"))
    return spans.mapInArrow(add, _POINT_SCHEMA)


def _bootstrap_ranking(rows: DataFrame, metric: str, replicates: int, seed: int) -> DataFrame:
    placed = _placed(rows, value_edges(rows, ["y_pred"])["y_pred"]).withColumn("_positive", F.col("y_true") > 0).drop("y_true")
    # one row for each place and replicate from here on
    higher = Window.partitionBy("replicate").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)

    def with_before(sums: DataFrame) -> DataFrame:
        return sums.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(higher), F.lit(0.0)) for c in ("tp", "fp")})

    before = None
    if metric == "PR":
        before = {}
        sums = with_before(_place_sums(placed, replicates, seed)).filter("place % 2 = 1")
        for row in sums.select("place", "replicate", "tp_before", "fp_before").collect():
            held = before.setdefault(row[0], np.zeros((2, replicates)))
            held[:, row[1] - 1] = row[2], row[3]
    # at an edge all scores are equal, so its sums are enough
    edges = _place_sums(placed.filter("_place % 2 = 0"), replicates, seed)
    joined = with_before(_span_sums(placed, replicates, seed, before).unionByName(edges, allowMissingColumns=True))
    tp, fp = F.col("tp"), F.col("fp")
    if metric == "AUC":
        own = F.coalesce("extra", fp * tp / 2)
        value = F.try_divide(F.sum(own + fp * F.col("tp_before")), F.sum("tp") * F.sum("fp"))
    else:
        all_tp = F.col("tp_before") + tp
        own = F.coalesce("extra", F.try_divide(tp * all_tp, all_tp + F.col("fp_before") + fp), F.lit(0.0))
        value = F.try_divide(F.sum(own), F.sum("tp"))
    return joined.groupBy("replicate").agg(value.alias("value"))


def bootstrap_metric(
    predictions: DataFrame,
    metric: str,
    replicates: int = BOOTSTRAP_REPLICATES,
    seed: int = 42,
    key: str = "row_id",
) -> DataFrame:
    """(replicate, value): the metric (AUC, PR, Brier, MAE or RMSE) on each resample.

    Rows do not fan out to their replicates: a task holds the weights of a few rows for all replicates and
    sums them up. Means need no shuffle of rows; ranking metrics shuffle each row once, by spans of scores.
    """
    rows = scored(predictions).select(
        F.col("y_true").cast("double").alias("y_true"), F.col("y_pred").cast("double").alias("y_pred"),
        F.col(key).cast("string").alias("_key"),
    )
    if metric in ("AUC", "PR"):
        return _bootstrap_ranking(rows, metric, replicates, seed)
    if metric not in ("Brier", "MAE", "RMSE"):
        raise ValueError(f"unknown metric {metric!r}")

    def add(batches):
        sums = np.zeros((2, replicates))
        for c, w in _chunks(batches, replicates, seed):
            error = np.abs(c["y_true"] - c["y_pred"])
            sums += (error if metric == "MAE" else error**2) @ w, w.sum(axis=0)
        yield _long_rows(_POINT, 0, *sums, np.zeros(replicates))

    spread = rows.repartition(bucket_count(rows))  # a small table in one file would be one task of many hashes
    mean = F.try_divide(F.sum("tp"), F.sum("fp"))
    found = spread.mapInArrow(add, _POINT_SCHEMA).groupBy("replicate")
    return found.agg((F.sqrt(mean) if metric == "RMSE" else mean).alias("value"))


def bootstrap_interval(
    predictions: DataFrame,
    metric: str,
    replicates: int = BOOTSTRAP_REPLICATES,
    seed: int = 42,
    key: str = "row_id",
) -> DataFrame:
    """One row (metric, used, lower, upper): the 95 % interval over the replicates that have a value.

    The interval is null for fewer than five rows.
    """
    values = bootstrap_metric(predictions, metric, replicates, seed, key)
    interval = values.agg(
        F.count("value").alias("used"),
        F.percentile("value", F.lit(0.025)).alias("lower"),  # over ``replicates`` values
        F.percentile("value", F.lit(0.975)).alias("upper"),
    )
    n = scored(predictions).agg(F.count(F.lit(1)).alias("rows")).scalar()
    enough = n >= MIN_BOOTSTRAP_ROWS
    return interval.select(
        F.lit(metric).alias("metric"),
        F.when(enough, F.col("used")).otherwise(0).alias("used"),
        F.when(enough, F.col("lower")).alias("lower"),
        F.when(enough, F.col("upper")).alias("upper"),
    )


def class_weights(training: DataFrame, label: str = "y_true") -> DataFrame:
    """One row: class sizes, balanced weights n / (2·n_c), and negatives per positive (1 if none)."""
    positive = F.col(label).cast("double") > 0
    counts = training.agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    n = F.col("positives") + F.col("negatives")
    return counts.select(
        "positives",
        "negatives",
        F.try_divide(n, 2 * F.col("positives")).alias("weight_positive"),
        F.try_divide(n, 2 * F.col("negatives")).alias("weight_negative"),
        F.coalesce(F.try_divide(F.col("negatives"), F.col("positives")), F.lit(1.0)).alias("scale_pos_weight"),
    )


def calibration_table(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Mean outcome and mean prediction per equal-width, right-closed bin of the prediction."""
    p = F.col("y_pred")
    ends = predictions.agg(F.min(p).alias("lo"), F.max(p).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    width = (hi - lo) / bins
    # a constant prediction has no width and falls into bin 1, as does the minimum
    position = F.coalesce(F.ceil(F.try_divide(p - lo, width)), F.lit(1))
    return (
        predictions.filter(p.isNotNull())
        .withColumn("bin", F.least(F.greatest(position, F.lit(1)), F.lit(bins)))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("y_true").alias("mean_true"),
            F.avg("y_pred").alias("mean_pred"),
        )
    )


def ols_trend(predictions: DataFrame) -> DataFrame:
    """Straight line of the prediction on the outcome."""
    x, y = F.col("y_true"), F.col("y_pred")
    return predictions.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def compare_models(metric_rows: list[DataFrame]) -> DataFrame:
    """One row per model from separately computed metric rows; absent metrics are null."""
    out = metric_rows[0]
    for rows in metric_rows[1:]:
        out = out.unionByName(rows, allowMissingColumns=True)
    return out

