"""Arrival-order operators of the ingest path: duplicates and the per-driver rate limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default limits of the ingest path.
MAX_EVENTS_PER_WINDOW = 20
WINDOW_MS = 1000

RATE_SLICE_MS = 60_000


def mark_duplicates(
    arrivals: DataFrame, order: list[str], key: str = "event_id", seen: DataFrame | None = None
) -> DataFrame:
    """Add ``is_duplicate``: an earlier arrival carried the same id, or ``seen`` (distinct ids) holds it.

    The first arrival of an id is found by a map-side combined minimum, and only ids that really
    repeat are joined back, so an id with very many copies is never gathered in one window. Arrivals
    without an id are no duplicates.
    """
    place = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    repeated = (
        arrivals.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .filter("_n > 1")
        .select(F.col(key).alias("_key"), "_first")
    )
    joined = arrivals.join(repeated, arrivals[key] == repeated["_key"], "left")
    late = F.coalesce(place > F.col("_first"), F.lit(False))
    if seen is not None:
        before = seen.select(F.col(key).alias("_seen"))
        joined = joined.join(before, joined[key] == before["_seen"], "left")
        late = late | F.col("_seen").isNotNull()
    return joined.withColumn("is_duplicate", late).drop("_key", "_first", "_seen")


def _fold(limit: int, window_ms: int, key: str, at: str):
    """How many arrivals of each instant are accepted, by (key, chain) in order of time; remembers ``limit`` instants."""

    def decide(batches):
        from collections import deque

        import pyarrow as pa

        current, recent = None, deque()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in (key, "_chain", at, "_given", "_n")), strict=True)
            taken = []
            for k, chain, t, known, n in rows:
                if (k, chain) != current:
                    current, recent = (k, chain), deque()
                while recent and recent[0] < t - window_ms:
                    recent.popleft()
                taken.append(min(n, limit if known else limit - len(recent)))
                recent.extend([t] * taken[-1])
            yield batch.append_column("_taken", pa.array(taken, pa.int64()))

    return decide


def rate_limit(
    arrivals: DataFrame,
    key: str = "driver_id",
    at: str = "arrival_ms",
    order: list[str] = ["arrival_no"],
    limit: int = MAX_EVENTS_PER_WINDOW,
    window_ms: int = WINDOW_MS,
    slice_ms: int = RATE_SLICE_MS,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Add ``accepted``: fewer than ``limit`` *accepted* arrivals of the key in [t − window, t] before it.

    An arrival with fewer than ``limit`` earlier arrivals of any kind in its window is accepted
    whatever happened before. Only the others, the contested ones, depend on earlier verdicts. Time
    is cut into slices (each also sees the last window of the slice before), and

    * slices without a contested arrival accept everything, without leaving the JVM;
    * a slice whose predecessor ends quietly starts from a known state, the predecessor's tail;
    * only slices joined by contested arrivals on their border form a chain. Its arrivals collapse to
      one row per instant before any shuffle, so a chain is as long as its milliseconds, however many
      arrivals a flood brings; one task decides how many of each instant are accepted, and the first
      ones of an instant are.

    ``recent`` are arrivals (key, at) that were accepted before, as after an earlier micro-batch.
    Arrivals without a key are not limited. ``order`` tells arrivals of one key and instant apart.
    """
    if slice_ms <= window_ms:
        raise ValueError("a slice must be longer than the window")
    rows = arrivals.withColumn("_known", F.lit(False))
    if recent is not None:
        rows = rows.unionByName(recent.select(key, at, F.lit(True).alias("_known")), allowMissingColumns=True)
    here = F.floor(F.col(at) / slice_ms)
    reaches_next = F.col(at) >= (here + 1) * slice_ms - window_ms
    rows = rows.withColumn("_home", here).withColumn(
        "_slice", F.explode(F.when(reaches_next, F.array(here, here + 1)).otherwise(F.array(here)))
    )
    inside = Window.partitionBy(key, "_slice").orderBy(at, *order)
    # only a full history of ``limit`` arrivals can contest the next one
    rows = rows.withColumn("_given", F.col("_known") | (F.col("_home") != F.col("_slice"))).withColumn(
        "_contested",
        ~F.col("_given") & F.coalesce(F.lag(at, limit).over(inside) >= F.col(at) - window_ms, F.lit(False)),
    )

    tail = F.col(at) >= (F.col("_slice") + 1) * slice_ms - window_ms
    slices = (
        rows.groupBy(key, "_slice")
        .agg(
            F.max("_contested").alias("_hot"),
            F.max(F.col("_contested") & tail).alias("_restless_end"),
        )
        .filter("_hot")
    )
    across = Window.partitionBy(key).orderBy("_slice")
    continues = (F.lag("_slice").over(across) == F.col("_slice") - 1) & F.lag("_restless_end").over(across)
    chains = slices.withColumn(
        "_start", F.when(F.coalesce(continues, F.lit(False)), F.lit(None)).otherwise(F.col("_slice"))
    ).select(
        F.col(key),
        "_slice",
        F.max("_start").over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("_chain"),
    )
    renamed = chains.withColumnsRenamed({key: "_r_key", "_slice": "_r_slice"})
    placed = rows.join(
        renamed,
        (rows[key] == renamed["_r_key"]) & (rows["_slice"] == renamed["_r_slice"]),
        "left",
    ).drop("_r_key", "_r_slice")

    # within a chain, the tail handed on by a slice of the same chain is already there
    own = ~F.col("_given") | (F.col("_slice") == F.col("_chain")) | (F.col("_home") == F.col("_slice"))
    instants = placed.filter(F.col("_chain").isNotNull() & own).groupBy(key, "_chain", at, "_given").agg(
        F.count(F.lit(1)).alias("_n")
    )
    schema = T.StructType([*instants.schema.fields, T.StructField("_taken", T.LongType())])
    taken = (
        instants.repartition(F.col(key), F.col("_chain"))
        .sortWithinPartitions(key, "_chain", at, F.col("_given").desc())
        .mapInArrow(_fold(limit, window_ms, key, at), schema)
        .filter(~F.col("_given"))
        .select(F.col(key).alias("_t_key"), F.col(at).alias("_t_at"), "_taken")
    )
    # at most ``limit`` of an instant can be accepted: ranks are cut per task before the shuffle
    rank = F.row_number().over(Window.partitionBy(key, at).orderBy(*order))
    contested = placed.filter(F.col("_chain").isNotNull() & ~F.col("_given"))
    first = contested.select(*dict.fromkeys([key, at, *order])).withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    ranked = first.join(taken, (first[key] == taken["_t_key"]) & (first[at] == taken["_t_at"]))
    passed = ranked.filter(F.col("_rank") <= F.col("_taken")).select(
        F.col(key).alias("_p_key"), *[F.col(c).alias(f"_p_{c}") for c in dict.fromkeys([at, *order])], F.lit(True).alias("_passed")
    )
    decided = placed.filter(~F.col("_given"))
    same = decided[key] == passed["_p_key"]
    for c in dict.fromkeys([at, *order]):
        same = same & decided[c].eqNullSafe(passed[f"_p_{c}"])
    accepted = F.col("_chain").isNull() | F.col("_passed").isNotNull()
    return decided.join(passed, same, "left").select(*arrivals.columns, accepted.alias("accepted"))
