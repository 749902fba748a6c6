"""Order-dependent operators whose work is split below the key.

A plain window keeps all rows of one key in one task. Here a key's rows are cut into slices (of time)
or buckets (of a value); windows run per slice, a small summary per slice carries the running state
across, and one join brings it back. A key that holds a third of all rows is thus spread over many
tasks, and results do not depend on where the cuts lie.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milemark.schemas import null_if_nan
from milemark.session import store

DEFAULT_SLICE_MS = 900_000


def _sliced(df: DataFrame, ts: str, slice_ms: int) -> DataFrame:
    return df.withColumn("_slice", F.floor(F.col(ts) / slice_ms))


def _join_summary(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Bring the summary back to the rows, which are already partitioned by these keys.

    Plain equality keeps that partitioning (a null-safe one would shuffle the rows again), so rows
    without a key get no summary.
    """
    renamed = summary.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & (rows[k] == renamed[f"_r_{k}"])
    return rows.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])


def place_in_order(
    events: DataFrame, keys: list[str], order: list[str], ts: str = "ts", slice_ms: int = DEFAULT_SLICE_MS
) -> DataFrame:
    """Add ``place`` (1, 2, … per key) in a stated order that starts with the time."""
    rows = _sliced(events, ts, slice_ms)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = rows.withColumn("_local", F.row_number().over(inside))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        rows.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = _join_summary(rows, summary, [*keys, "_slice"])
    return joined.withColumn("place", F.col("_before") + F.col("_local")).drop("_slice", "_local", "_before")


def sessionize(
    events: DataFrame,
    keys: list[str] = ["driver_id"],
    ts: str = "ts",
    order: list[str] = ["ts", "event_id"],
    max_gap_ms: int = 300_000,
    slice_ms: int = DEFAULT_SLICE_MS,
) -> DataFrame:
    """Add ``session_seq`` (1, 2, … per key): a gap above ``max_gap_ms`` starts a new session.

    Rows without a key belong to no session.
    """
    rows = _sliced(events, ts, slice_ms)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = rows.withColumn(
        "_starts", F.coalesce(F.col(ts) - F.lag(ts).over(inside) > max_gap_ms, F.lit(False)).cast("int")
    ).withColumn("_local", F.sum("_starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))

    per_slice = rows.groupBy(*keys, "_slice").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("_starts").alias("_n")
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    opens = F.coalesce(F.col("_first") - F.lag("_last").over(across) > max_gap_ms, F.lit(True))
    summary = (
        per_slice.withColumn("_opens", opens.cast("int"))
        .withColumn(
            "_before", F.sum(F.col("_opens") + F.col("_n")).over(across.rowsBetween(Window.unboundedPreceding, 0))
        )
        .select(*keys, "_slice", (F.col("_before") - F.col("_n")).alias("_offset"))
    )
    joined = _join_summary(rows, summary, [*keys, "_slice"])
    return joined.withColumn("session_seq", F.col("_offset") + F.col("_local")).drop(
        "_slice", "_starts", "_local", "_offset"
    )


def running_max_before(
    events: DataFrame,
    value: str,
    out: str,
    keys: list[str],
    ts: str = "ts",
    order: list[str] = ["ts", "event_seq_no", "event_id"],
    slice_ms: int = DEFAULT_SLICE_MS,
) -> DataFrame:
    """Add the maximum of ``value`` over all earlier rows of the key; null for the first row of a key
    and for rows without a key."""
    rows = _sliced(events, ts, slice_ms)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = rows.withColumn("_local", F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    across = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        rows.groupBy(*keys, "_slice")
        .agg(F.max(value).alias("_top"))
        .select(*keys, "_slice", F.max("_top").over(across).alias("_earlier"))
    )
    joined = _join_summary(rows, summary, [*keys, "_slice"])
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    # greatest skips nulls, so whichever side is known counts
    return joined.withColumn(out, F.when(has_key, F.greatest("_local", "_earlier"))).drop(
        "_slice", "_local", "_earlier"
    )


def bucket_count(df: DataFrame) -> int:
    """As many buckets as a shuffle has partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def value_edges(df: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """Approximate quantiles that cut each column into buckets of similar size.

    One number per bucket and column reaches the driver. The cuts only steer balance: any cuts give
    the same results. NaN counts as null; infinite values take the outermost buckets.
    """
    n = bucket_count(df)
    probabilities = [i / n for i in range(1, n)]
    row = df.agg(
        *[
            F.percentile_approx(null_if_nan(F.col(c).cast("double")), probabilities, max(10_000, 10 * n)).alias(c)
            for c in columns
        ]
    ).first()
    return {c: sorted({edge for edge in row[c] or [] if math.isfinite(edge)}) for c in columns}


def with_bucket(df: DataFrame, value: str, edges: list[float], out: str = "_bucket") -> DataFrame:
    """Add the number of edges up to ``value``; null and NaN get the last one.

    The edges are looked up by a binary search in one sorted array, so neither the plan nor the generated code grows
    with their number.
    """
    if not edges:
        return df.withColumn(out, F.lit(0))
    search = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_value", outputCol="_place", handleInvalid="keep")
    placed = search.transform(df.withColumn("_value", F.coalesce(F.col(value).cast("double"), F.lit(math.nan))))
    return placed.withColumn(out, F.least(F.col("_place").cast("int"), F.lit(len(edges)))).drop("_value", "_place")


def ranged(df: DataFrame, columns: list[str], name: str = "ranged") -> DataFrame:
    """Rows dealt into ranges of ``columns`` (nulls first), with the number of the range in ``_bucket``.

    Spark samples the ranges' ends, so they hold similar numbers of rows whatever the values, and no list of edges
    reaches an expression. The rows are written once: ranges must be the same wherever they are read.
    """
    return store(df.repartitionByRange(*columns).withColumn("_bucket", F.spark_partition_id()), name)


def prefix_sums(
    df: DataFrame, value: str, sums: list[str], by: list[str] = [], descending: bool = False
) -> DataFrame:
    """For rows that are distinct per (by, value) and carry ``_bucket``: running and total sums.

    Adds ``<s>_cum`` (up to and including the row, in order of ``value``) and ``<s>_total``.
    """

    def ordered(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    inside = (
        Window.partitionBy(*by, "_bucket").orderBy(ordered(value)).rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = df.withColumns({f"{s}_cum": F.sum(s).over(inside) for s in sums})

    # at most one row per bucket and ``by`` group from here on
    per_bucket = df.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(ordered("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    summary = per_bucket.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}_before") for s in sums],
        *[F.sum(f"_{s}").over(group).alias(f"{s}_total") for s in sums],
    )
    joined = _join_summary(rows, summary, [*by, "_bucket"])
    return joined.withColumns({f"{s}_cum": F.col(f"{s}_cum") + F.col(f"_{s}_before") for s in sums}).drop(
        "_bucket", *[f"_{s}_before" for s in sums]
    )


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """(column, n, q0, q1, …): exact quantiles with linear interpolation, nulls and NaN left out; two
    equal values are their own middle, also if infinite.

    Counts per distinct value are collapsed before the shuffle and dealt into ranges of (column, value); ranks come from
    prefix sums inside a range and the ranges' totals. The rows are read once.
    """
    placed = df.select(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    long = placed.select(F.explode(F.array(*pairs)).alias("s")).select("s.*").filter(F.col("value").isNotNull())
    counts = ranged(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), ["column", "value"], "quantiles")
    ranked = prefix_sums(counts, "value", ["n"], by=["column"])

    def at(rank: Column) -> Column:
        here = (F.col("n_cum") - F.col("n") <= rank) & (rank < F.col("n_cum"))
        return F.max(F.when(here, F.col("value")))

    picks = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        picks += [at(F.floor(position)).alias(f"_lo{i}"), at(F.ceil(position)).alias(f"_hi{i}")]
    per_column = ranked.groupBy("column").agg(F.max("n_total").alias("n"), *picks)
    out = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (position - F.floor(position))).alias(f"q{i}"))
    return per_column.select("column", "n", *out)
