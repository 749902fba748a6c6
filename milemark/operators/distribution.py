"""Distribution statistics of columns: value counts, summaries, histograms, boxes, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milemark.operators.ordered import exact_quantiles

HISTOGRAM_BINS = 30


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) with one row per input row and column."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("s")
    ).select("s.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share) of the non-null values."""
    known = df.filter(F.col(column).isNotNull())
    total = known.agg(F.count(F.lit(1))).scalar()
    return (
        known.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", F.col("n") / total)
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, missing, mean, std, min, q25, q50, q75, max); quartiles are exact.

    Values are aggregated in long form: a few aggregates with one group per column, combined in each
    task, instead of many aggregates whose generated code grows with the table's width.
    """
    x = F.col("value")
    moments = _long(df, columns).groupBy("column").agg(
        F.count(x).alias("count"),
        F.count_if(x.isNull()).alias("missing"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    return moments.join(quartiles, "column", "left")


def feature_means(df: DataFrame, columns: list[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return _long(df, present).groupBy("column").agg(F.avg("value").alias("mean"))


def histogram(
    df: DataFrame, column: str, bins: int = HISTOGRAM_BINS, by: list[str] = []
) -> DataFrame:
    """(by…, bin, n) over ``bins`` equal-width bins between minimum and maximum; empty bins left out.

    Bins are left-closed, the last one is closed on both sides; a constant column fills bin 0.
    """
    x = F.col(column)
    known = df.filter(x.isNotNull())
    ends = known.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    position = F.floor(F.try_divide((x - lo) * bins, hi - lo))
    return (
        known.withColumn("bin", F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, q1, median, q3, whiskers, outliers): whiskers reach the last value within 1.5 IQR."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    # one row per named column, whatever the table's size: without the broadcast, all rows of a column
    # would meet in one task
    placed = _long(df, columns).filter(F.col("value").isNotNull()).join(F.broadcast(quartiles), "column")
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return placed.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, r) for all ordered pairs of the columns, in one pass; rows fan out to pairs and are summed up again
    before any shuffle.

    Like a table of pairwise-complete observations: a row counts for a pair if both are known.
    """
    pairs = [
        F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(x).cast("double").alias("a"), F.col(y).cast("double").alias("b")
        )
        for i, x in enumerate(columns)
        for y in columns[i:]
    ]
    # one group per pair, combined in each task; a constant column has no correlation
    r = F.try_divide(F.covar_pop("a", "b"), F.stddev_pop("a") * F.stddev_pop("b"))
    upper = (
        df.select(F.explode(F.array(*pairs)).alias("s"))
        .select("s.*")
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("x", "y")
        .agg(r.alias("r"))
    )
    both = upper.select(
        F.explode(
            F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(
                F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
            )
        ).alias("s"),
        "r",
    )
    return both.select("s.x", "s.y", "r")


def profile(df: DataFrame, numeric: list[str], approximate: bool = False) -> DataFrame:
    """(column, missing_pct, mean, variance, skewness, cardinality, quantiles, flags) per numeric column.

    Cardinality is exact by default, counted over (column, value) pairs that were made distinct first;
    ``approximate`` uses a sketch instead.
    """
    x = F.col("value")
    long = _long(df, numeric)
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(x).alias("known"),
        F.avg(x).alias("mean"),
        F.var_samp(x).alias("variance"),
        F.skewness(x).alias("skewness"),
    )
    long = long.filter(x.isNotNull())
    if approximate:
        distinct = long.groupBy("column").agg(F.approx_count_distinct("value").alias("cardinality"))
    else:
        distinct = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("cardinality"))
    boxes = box_statistics(df, numeric).select("column", "q1", "median", "q3", "outliers")
    joined = moments.join(distinct, "column", "left").join(boxes, "column", "left")
    return joined.select(
        "column",
        (100.0 * (F.col("rows") - F.col("known")) / F.col("rows")).alias("missing_pct"),
        "mean",
        "variance",
        "skewness",
        F.coalesce("cardinality", F.lit(0)).alias("cardinality"),
        "q1",
        "median",
        "q3",
        F.coalesce("outliers", F.lit(0)).alias("outliers"),
        (F.coalesce("cardinality", F.lit(0)) <= 1).alias("is_constant"),
        F.coalesce(F.abs("skewness") > 1, F.lit(False)).alias("is_skewed"),
        (F.coalesce("outliers", F.lit(0)) > 0).alias("has_outliers"),
    )


def top_values(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """(column, value, n): the most frequent values of each column, ties by value."""
    counted = (
        df.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
            ).alias("s")
        )
        .select("s.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # ranks are cut per task before the shuffle, so a column of many values stays cheap
    ranking = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    return counted.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= n)
