"""Monitoring views: key figures of the layers, the training set, premiums and the registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milemark.functions.driving import MS_PER_DAY
from milemark.operators.cleaning import label_columns
from milemark.operators.ordered import exact_quantiles, prefix_sums, ranged

HIGH_RISK_FACTOR = 1.5

# Outcomes of the ingest path, in the order of its stages.
OUTCOMES = ["INVALID_JSON", "UNAUTHORIZED", "DUPLICATE_EVENT", "RATE_LIMIT_EXCEEDED", "REJECTED", "ACCEPTED"]
COUNTERS = {
    "accepted": "ACCEPTED",
    "rejected": "REJECTED",
    "unauth": "UNAUTHORIZED",
    "duplicates": "DUPLICATE_EVENT",
    "rate_limited": "RATE_LIMIT_EXCEEDED",
}


def claim_kpis(training: DataFrame) -> DataFrame:
    """Samples, claim rate, claims, and mean amount among claimants; null where a column is missing."""
    claim, amount = label_columns(training.columns)
    occurred = F.col(claim).cast("boolean") if claim else F.lit(None).cast("boolean")
    paid = F.col(amount) if amount else F.lit(None).cast("double")
    return training.agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(occurred.cast("int")).alias("claim_rate"),
        F.count_if(occurred).alias("claims"),
        F.avg(F.when(occurred, paid)).alias("mean_severity"),
    )


def premium_kpis(premiums: DataFrame, factor: float = HIGH_RISK_FACTOR) -> DataFrame:
    """Drivers priced, mean premium, and how many premiums exceed ``factor`` × the exact median."""
    median = exact_quantiles(premiums, ["premium"], [0.5]).select("q0").scalar()
    return premiums.agg(
        F.count_distinct("driver_id").alias("drivers"),
        F.avg("premium").alias("mean_premium"),
        F.count_if(F.col("premium") > median * factor).alias("high_risk"),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, rows); a table that does not exist is simply not passed."""
    counts = [
        df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows")) for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def activity(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Events, distinct drivers, whole days between the first and the last event."""
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("driver_id").alias("drivers"),
        F.floor((F.max(ts) - F.min(ts)) / MS_PER_DAY).alias("days"),
    )


def lateness(events: DataFrame) -> DataFrame:
    """How long events took to arrive, in milliseconds."""
    delay = F.col("ingestion_ts") - F.col("ts")
    return events.agg(
        F.count(delay).alias("events"),
        F.avg(delay).alias("mean_ms"),
        F.min(delay).alias("min_ms"),
        F.max(delay).alias("max_ms"),
    )


def outcome_counters(classified: DataFrame) -> DataFrame:
    """(counter, n) with a row for every counter, also where nothing was counted."""
    aggregated = classified.agg(
        *[F.count_if(F.col("outcome") == outcome).alias(name) for name, outcome in COUNTERS.items()]
    )
    pairs = ", ".join(f"'{name}', `{name}`" for name in COUNTERS)
    return aggregated.selectExpr(f"stack({len(COUNTERS)}, {pairs}) as (counter, n)")


def latest_per_model(registry: DataFrame, order: list[str] = ["created_at"]) -> DataFrame:
    """The newest entry of each model name."""
    newest = Window.partitionBy("name").orderBy(*[F.col(c).desc() for c in order])
    return registry.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def last_entries(registry: DataFrame, n: int = 10, order: list[str] = ["created_at"]) -> DataFrame:
    return registry.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def models_by_metric(summary: DataFrame, metric: str, descending: bool) -> DataFrame:
    """Add ``place``, the rank of each model by a metric (equal figures share one; unknown ones have none).

    Places come from counts by figure and their running sums, so no window holds the whole summary.
    """
    counts = summary.filter(F.col(metric).isNotNull()).groupBy(metric).agg(F.count(F.lit(1)).alias("n"))
    ranked = prefix_sums(ranged(counts, [metric], "figures"), metric, ["n"], descending=descending)
    places = ranked.select(F.col(metric).alias("_figure"), (F.col("n_cum") - F.col("n") + 1).alias("place"))
    return summary.join(places, F.col(metric) == F.col("_figure"), "left").drop("_figure")


DEFAULT_FREQUENCY_MODEL = "frequency_rf"
DEFAULT_SEVERITY_MODEL = "severity_xgb"


def best_models(summary: DataFrame, models_dir: str | None = None) -> DataFrame:
    """One row (frequency_artifact, severity_artifact): highest AUC among models named Frequency,
    lowest MAE among those named Severity; unknown metrics last, ties by name; where there is none, the
    default model, below ``models_dir``."""
    folder = "" if models_dir is None else f"{models_dir.rstrip('/')}/"

    def first(kind: str, order: list) -> DataFrame:
        # two aggregates rather than a sort: the summary may be any size and is read once
        return summary.filter(F.col("Model").contains(kind)).agg(
            F.min_by("artifact", F.struct(*order)).alias("artifact"), F.lit(kind).alias("kind")
        )

    frequency = first("Frequency", [F.col("AUC").isNull(), -F.col("AUC"), F.col("Model")])
    severity = first("Severity", [F.col("MAE").isNull(), F.col("MAE"), F.col("Model")])
    both = frequency.unionByName(severity)

    def pick(kind: str, default: str):
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("artifact"))), F.lit(folder + default))

    return both.agg(
        pick("Frequency", DEFAULT_FREQUENCY_MODEL).alias("frequency_artifact"),
        pick("Severity", DEFAULT_SEVERITY_MODEL).alias("severity_artifact"),
    )
