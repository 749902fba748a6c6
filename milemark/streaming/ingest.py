"""The ingest path as Structured Streaming.

Requests arrive as files (or any other streaming source) with the columns arrival_no, arrival_ms,
body and signature. ``ingest_stream`` runs the operators of the batch path on each micro-batch and keeps
what they must remember in tables by micro-batch, so it survives lost executors and restarts;
``limit_rate_stream`` is the rate limit alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from milemark.functions.driving import instant
from milemark.operators import ingest, monitoring
from milemark.operators.arrivals import MAX_EVENTS_PER_WINDOW, WINDOW_MS, rate_limit
from milemark.operators.recency import remember
from milemark.session import Scratch
from milemark.sources import readers

REQUESTS = T.StructType(
    [
        T.StructField("arrival_no", T.LongType()),
        T.StructField("arrival_ms", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("signature", T.StringType()),
    ]
)

def request_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """New JSON-lines files below ``path``, with the arrival as event time."""
    return (
        spark.readStream.schema(REQUESTS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(path)
        .withColumn("arrived_at", instant(F.col("arrival_ms")))
    )


def _still_recent(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    """Arrivals (driver_id, arrival_ms) within the limit that the micro-batch before left behind."""
    if batch_id == 0:
        return None
    schema = "driver_id string, arrival_ms long"
    return readers.optional(spark.read.schema(schema).parquet, f"{base}/recent/batch={batch_id - 1}")


def _write_recent(passed: DataFrame, recent: DataFrame | None, base: str, batch_id: int, window_ms: int) -> None:
    """Only the last window can matter later: silent drivers are forgotten with it."""
    passed = passed.select("driver_id", "arrival_ms")
    if recent is not None:
        passed = passed.unionByName(recent)
    last = passed.agg(F.max("arrival_ms")).scalar()
    passed.filter(F.col("arrival_ms") >= last - window_ms).write.mode("overwrite").parquet(f"{base}/recent/batch={batch_id}")


def limit_rate_stream(
    arrivals: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
    limit: int = MAX_EVENTS_PER_WINDOW, window_ms: int = WINDOW_MS,
) -> StreamingQuery:
    """The rate limit alone, over narrow rows (arrival_no, arrival_ms, driver_id): ``decided`` below ``base`` holds them
    with ``accepted``, by micro-batch. The state is the last window's accepted arrivals."""

    def take(batch: DataFrame, batch_id: int) -> None:
        recent = _still_recent(batch.sparkSession, base, batch_id)
        folder = f"{base}/decided/batch={batch_id}"
        decided = rate_limit(batch, limit=limit, window_ms=window_ms, recent=recent)
        decided.write.mode("overwrite").parquet(folder)
        written = batch.sparkSession.read.schema(decided.schema).parquet(folder)
        _write_recent(written.filter("accepted"), recent, base, batch_id, window_ms)

    return (
        arrivals.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def take_micro_batch(
    requests: DataFrame, device_keys: DataFrame, base: str, batch_id: int, remember_ms: int | None = None,
    window_ms: int = WINDOW_MS, capacity: int | None = None, **limits,
) -> None:
    """Classify one micro-batch with the operators of the batch path, and carry their state on.

    Every request gets an outcome, late ones and those without an id included. Written below ``base``, in
    folders named after the batch so that repeating it replaces its files: ``bronze``, ``dead_letters``,
    ``outcomes`` (one narrow row per request), ``seen`` (ids) and ``recent`` (arrivals within the limit of
    the last window). ``remember_ms`` bounds how far back ids are looked up, in arrival time.

    With ``capacity`` only the last so many distinct ids are remembered: ``cache`` holds them, at most ``capacity`` rows
    for each micro-batch, so its work does not grow with the stream; ``seen`` is neither read nor written then.
    """
    spark = requests.sparkSession
    folder = f"batch={batch_id}"
    cache = None
    if capacity is not None and batch_id > 0:
        cache = readers.optional(spark.read.schema("event_id string, turn long").parquet, f"{base}/cache/batch={batch_id - 1}")
    seen = None if capacity is not None else readers.optional(spark.read.schema("event_id string, arrival_ms long, batch long").parquet, f"{base}/seen")
    if seen is not None:
        seen = seen.filter(F.col("batch") < batch_id)
        if remember_ms is not None:
            first = requests.agg(F.min("arrival_ms")).scalar()
            seen = seen.filter(F.col("arrival_ms") >= first - remember_ms)
        seen = seen.select("event_id")
    recent = _still_recent(spark, base, batch_id)
    with Scratch(spark) as scratch:
        classified = ingest.classify(
            requests, device_keys, window_ms=window_ms, seen=seen, recent=recent, capacity=capacity, cache=cache,
            keep=scratch.keep, **limits,
        )
        ingest.accepted_events(classified).write.mode("overwrite").parquet(f"{base}/bronze/{folder}")
        ingest.dead_letters(classified).write.mode("overwrite").json(f"{base}/dead_letters/{folder}")
        narrow = classified.select("arrival_no", "arrival_ms", "event_id", "driver_id", "outcome", "reason")
        narrow.write.mode("overwrite").parquet(f"{base}/outcomes/{folder}")
    outcomes = spark.read.schema(narrow.schema).parquet(f"{base}/outcomes/{folder}")
    known = outcomes.filter(~F.col("outcome").isin("INVALID_JSON", "UNAUTHORIZED", "DUPLICATE_EVENT"))
    if capacity is None:
        ids = known.filter(F.col("event_id").isNotNull()).select("event_id", "arrival_ms")
        ids.write.mode("overwrite").parquet(f"{base}/seen/{folder}")
    else:
        candidates = outcomes.filter(~F.col("outcome").isin("INVALID_JSON", "UNAUTHORIZED"))
        held = remember(candidates, ["arrival_ms", "arrival_no"], capacity=capacity, cache=cache)
        held.write.mode("overwrite").parquet(f"{base}/cache/{folder}")
    _write_recent(known.filter("outcome <> 'RATE_LIMIT_EXCEEDED'"), recent, base, batch_id, window_ms)


def ingest_stream(
    requests: DataFrame, device_keys: DataFrame, base: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """The whole ingest path per micro-batch, see ``take_micro_batch``. Earlier ids and arrivals are tables, so a
    driver's flood and a very frequent id spread over tasks as they do in a batch."""

    def take(batch: DataFrame, batch_id: int) -> None:
        take_micro_batch(batch.drop("arrived_at"), device_keys, base, batch_id, **options)

    return (
        requests.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_counters(spark: SparkSession, base: str) -> DataFrame:
    """(counter, n) over all outcomes that ``ingest_stream`` has written so far."""
    outcomes = spark.read.schema("outcome string").option("recursiveFileLookup", "true").parquet(f"{base}/outcomes")
    return monitoring.outcome_counters(outcomes)


def write_bronze_stream(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Flush events to Parquet as they come; ``availableNow`` flushes what is there and stops."""
    return (
        events.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
