"""Bounded idempotency: an id is a duplicate while it is among the last ``capacity`` distinct ids.

A cache that forgets its least recently seen id answers by reuse distance: an arrival is a duplicate if fewer than
``capacity`` other ids came since the id's last arrival, which a hit counts as. Here that distance is counted offline, for
slices of the arrival order at once. What a slice needs to know of everything before it is the last ``capacity``
distinct ids in order of their last arrival. That summary is small and merges: a slice with so many ids of its own needs
none of the earlier ones, others are merged with 1, 2, 4, … slices before them, as far back as it takes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.session import store

# Fixed value: ids that the ingest path remembers.
REMEMBERED_IDS = 10_000

#: Arrivals in a slice, as multiple of the ids remembered, and at least.
SLICE_FACTOR = 4
LEAST_SLICE_ROWS = 40_000


def earlier_greater(values: np.ndarray) -> np.ndarray:
    """For each value, how many before it are greater: blocks of 1, 2, 4, … are merged, all pairs of a size at once."""
    n = len(values)
    size = 1 << max(0, n - 1).bit_length()
    v = np.zeros(size, np.int64)
    v[:n] = values - values.min(initial=0)
    counts = np.zeros(size, np.int64)
    width = 1
    while width < size:
        pairs = v.reshape(-1, 2, width)
        block = np.arange(len(pairs))[:, None]
        base = block * (int(v.max()) + 1)
        left = np.sort(pairs[:, 0], axis=1) + base
        upto = np.searchsorted(left.ravel(), (pairs[:, 1] + base).ravel(), side="right").reshape(-1, width) - block * width
        counts.reshape(-1, 2, width)[:, 1] += width - upto
        width *= 2
    return counts[:n]


def repeats(codes: np.ndarray, capacity: int) -> np.ndarray:
    """Whether fewer than ``capacity`` other codes came since each one's last place."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    before = np.full(n, -1)
    before[order[1:][same]] = order[:-1][same]
    between = np.arange(n) - before - 1
    found = (before >= 0) & (between < capacity)
    if (far := (before >= 0) & ~found).any():
        # places between that repeat a code from between are no further codes
        found[far] = (between - earlier_greater(before))[far] < capacity
    return found


def _latest(rows: DataFrame, capacity: int) -> DataFrame:
    """Of (slice, id, last) the ``capacity`` last ids of each slice, numbered from the latest."""
    ids = rows.groupBy("_slice", "_id").agg(F.max("_last").alias("_last"))
    order = Window.partitionBy("_slice").orderBy(F.desc("_last"))
    return ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= capacity)


def _summaries(rows: DataFrame, n_slices: int, capacity: int, keep: Callable) -> DataFrame:
    """(slice, id, last, rank): the last ``capacity`` distinct ids up to the end of each slice."""
    spark = rows.sparkSession
    known = keep(_latest(rows, capacity), "recent_ids")
    reach = 1
    while reach <= n_slices:
        held = known.groupBy("_slice").agg(F.count("*").alias("_n"))
        short = spark.range(-1, n_slices).select(F.col("id").cast("int").alias("_slice")).join(held, "_slice", "left")
        short = short.where((F.coalesce("_n", F.lit(0)) < capacity) & (F.col("_slice") - reach >= -1)).select("_slice")
        short = keep(short, "short_slices")
        if short.isEmpty():
            break
        behind = known.withColumn("_slice", F.col("_slice") + reach).join(short, "_slice", "left_semi")
        own = known.join(short, "_slice", "left_semi")
        merged = _latest(own.unionByName(behind).drop("_rank"), capacity)
        known = keep(known.join(short, "_slice", "left_anti").unionByName(merged), "recent_ids")
        reach *= 2
    return known


def mark_repeats(
    arrivals: DataFrame,
    order: list[str],
    key: str = "event_id",
    capacity: int = REMEMBERED_IDS,
    cache: DataFrame | None = None,
    slice_rows: int | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = store,
) -> DataFrame:
    """Add ``is_duplicate``: the id is among the last ``capacity`` distinct ids that arrived before.

    ``order`` must be unique. Every arrival counts as its id's latest, duplicates too. Arrivals without an id are no
    duplicates and are not remembered. ``cache`` (key, ``turn``) are ids that arrived earlier, the latest with the
    greatest turn, as ``remember`` leaves them. Slices are ranges of the order with about ``slice_rows`` arrivals, so a
    very frequent id or an instant of very many arrivals is no large task; no result depends on their ends. However few
    ids are remembered, a slice is worth a task.
    """
    if capacity < 1:
        raise ValueError("at least one id must be remembered")
    slice_rows = slice_rows or max(SLICE_FACTOR * capacity, LEAST_SLICE_ROWS)
    n_slices = max(1, math.ceil(arrivals.count() / slice_rows))
    sliced = arrivals.repartitionByRange(n_slices, *order).withColumn("_slice", F.spark_partition_id())
    sliced = keep(sliced, "sliced")
    turn = F.lit(0).cast("long")
    ids = sliced.where(F.col(key).isNotNull()).select("_slice", F.col(key).alias("_id"), _last(sliced, order, turn))
    if cache is not None:
        nothing = [F.lit(None).cast(sliced.schema[c].dataType).alias(c) for c in order]
        kept = F.struct(F.col("turn").cast("long").alias("turn"), *nothing).alias("_at")
        ids = ids.unionByName(cache.select(F.lit(-1).alias("_slice"), F.col(key).alias("_id"), F.struct(F.lit(-1).alias("slice"), kept).alias("_last")))
    before = _summaries(ids, n_slices, capacity, keep).select((F.col("_slice") + 1).alias("_slice"), "_id", "_rank")

    def mark(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in order])
        known = known.sort_by([("_rank", "descending")])
        has_id = rows.column(key).is_valid().to_numpy()
        names = pa.chunked_array([*known.column("_id").chunks, *rows.column(key).drop_null().chunks], rows.schema.field(key).type)
        codes = names.combine_chunks().dictionary_encode().indices.to_numpy() if len(names) else np.zeros(0, int)
        found = np.zeros(len(rows), bool)
        found[has_id] = repeats(codes, capacity)[len(known) :]
        return rows.drop_columns("_slice").append_column("is_duplicate", pa.array(found))

    schema = T.StructType([*arrivals.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    return sliced.groupBy("_slice").cogroup(before.groupBy("_slice")).applyInArrow(mark, schema)


def _last(rows: DataFrame, order: list[str], turn: Column) -> Column:
    return F.struct(F.col("_slice").alias("slice"), F.struct(turn.alias("turn"), *[F.col(c) for c in order]).alias("_at")).alias("_last")


def remember(
    arrivals: DataFrame, order: list[str], key: str = "event_id", capacity: int = REMEMBERED_IDS, cache: DataFrame | None = None
) -> DataFrame:
    """(key, turn): the last ``capacity`` distinct ids after these arrivals, the latest with the greatest turn."""
    ids = arrivals.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order)).alias("_at"))
    latest = ids.orderBy(F.desc("_at")).limit(capacity)
    own = latest.withColumn("_turn", F.row_number().over(Window.orderBy("_at"))).select(key, F.col("_turn").cast("long").alias("turn"))
    if cache is None:
        return own
    # at most ``capacity`` rows on both sides
    both = own.withColumn("turn", F.col("turn") + capacity).unionByName(cache.select(key, F.col("turn").cast("long").alias("turn")))
    once = both.groupBy(key).agg(F.max("turn").alias("turn")).orderBy(F.desc("turn")).limit(capacity)
    return once.withColumn("turn", F.row_number().over(Window.orderBy("turn")).cast("long"))
