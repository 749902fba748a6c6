"""Mergeable profiles: per file set and column, exact moments and extremes beside sketches of quantiles and cardinality.

A stored part is a few kilobytes whatever the rows it stands for, and parts merge without reading rows again. Counts, mean,
variance, skewness, minimum and maximum are exact; quantiles have a rank error of about 2.3 / k**0.9 (k = 800: 0.6 % at
99 % confidence), cardinality a relative standard error of 0.8 / 2**(lg_k / 2) (lg_k = 12: 1.3 %).

NaN counts as missing. A column without values has no moments, no quantiles and cardinality 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800
CARDINALITY_LG_K = 12


def profile_part(df: DataFrame, numeric: list[str], k: int = QUANTILE_K, lg_k: int = CARDINALITY_LG_K) -> DataFrame:
    """(column, rows, known, mean, m2, m3, min, max, quantiles, distinct): one row per numeric column, in one pass."""
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double") + 0.0)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), known(c).alias("x")) for c in numeric])
    grouped = df.select(F.explode(cells).alias("s")).select("s.*").groupBy("column")
    part = grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("x").alias("known"),
        F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("m2"),
        F.skewness("x").alias("skewness"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.kll_sketch_agg_double("x", F.lit(k)).alias("quantiles"),
        F.hll_sketch_agg(F.when(F.col("x").isNotNull(), F.xxhash64("x")), F.lit(lg_k)).alias("distinct"),
    )
    m3 = F.coalesce(F.nanvl("skewness", F.lit(0.0)), F.lit(0.0)) * F.pow("m2", 1.5) / F.sqrt("known")
    return part.select("column", "rows", "known", "mean", "m2", m3.alias("m3"), "min", "max", "quantiles", "distinct")


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same columns as one, in the form of a part: merged parts can be merged again."""
    n = F.col("known")
    whole = parts.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.try_divide(F.sum(n * F.col("mean")), F.sum(n)).alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )
    # deviations of the parts' means from the mean of all; the table has one row per part and column
    d = F.col("mean") - F.col("center")
    centered = parts.select("column", "known", "mean", "m2", "m3").join(
        whole.select("column", F.col("mean").alias("center")), "column"
    )
    moments = centered.groupBy("column").agg(
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * F.col("m2") * d + n * d * d * d).alias("m3"),
    )
    return whole.join(moments, "column").select(
        "column", "rows", "known", "mean", "m2", "m3", "min", "max", "quantiles", "distinct"
    )


def _quantile(q: float) -> Column:
    return F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))


def profile_of(merged: DataFrame) -> DataFrame:
    """The profile of one part or merged parts: (column, rows, missing_pct, mean, variance, skewness, min, max,
    cardinality, quartiles, flags); cardinality and quartiles are estimates."""
    n, m2 = F.col("known"), F.col("m2")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    beyond = (F.col("min") < F.col("q1") - reach) | (F.col("max") > F.col("q3") + reach)
    read = merged.select(
        "column",
        "rows",
        (100.0 * (F.col("rows") - n) / F.col("rows")).alias("missing_pct"),
        "mean",
        F.when(n > 1, m2 / (n - 1)).alias("variance"),
        F.when((m2 > 0) & (F.col("min") < F.col("max")), F.sqrt(n) * F.col("m3") / F.pow(m2, 1.5)).alias("skewness"),
        "min",
        "max",
        F.hll_sketch_estimate("distinct").alias("cardinality"),
        *[_quantile(q).alias(name) for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))],
    )
    return read.withColumns(
        {
            "is_constant": F.coalesce(F.col("min") == F.col("max"), F.lit(True)),
            "is_skewed": F.coalesce(F.abs("skewness") > 1, F.lit(False)),
            "has_outliers": F.coalesce(beyond, F.lit(False)),
        }
    )
