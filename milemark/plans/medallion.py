"""Composite jobs from requests or raw files to driver features. Each layer is written, then read by
the next: that is where lineage ends and a lost executor costs little."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.functions.driving import event_date
from milemark.operators import cleaning, features, ingest, trips
from milemark.schemas import SILVER_EVENTS, SILVER_TRIPS, conform
from milemark.session import store
from milemark.sources import readers, writers


def ingest_batch(
    requests: DataFrame, device_keys: DataFrame, bronze: str, dead_letters: str, batch: str | None = None, **limits
) -> DataFrame:
    """Classify requests once, write accepted events and dead letters; returns the classification.

    With a name for the ``batch`` its files get folders of their own, which a repeated run replaces; without
    one they are appended.
    """
    classified = ingest.classify(requests, device_keys, **limits)
    if batch is None:
        writers.write_bronze(ingest.accepted_events(classified), bronze, mode="append")
        writers.append_dead_letters(ingest.dead_letters(classified), dead_letters)
    else:
        writers.write_bronze(ingest.accepted_events(classified), f"{bronze}/batch={batch}")
        ingest.dead_letters(classified).write.mode("overwrite").json(f"{dead_letters}/batch={batch}")
    return classified


def raw_to_bronze(spark: SparkSession, raw: str, bronze: str, max_rows: int = writers.MAX_BRONZE_FILE_ROWS) -> None:
    writers.write_bronze(cleaning.dedup_events(readers.read_raw_events(spark, raw)), bronze, max_rows)


def clean(
    bronze_events: DataFrame,
    drop_invalid_enums: bool = True,
    check_heading: bool = False,
    sessions: bool = False,
    monotonic_odometer: bool = False,
    deduplicated: bool = False,
) -> DataFrame:
    """Bronze → Silver events. Heading, sessions and odometer checks are off unless asked for. Events that are
    ``deduplicated`` already are not sorted once more for it."""
    events = cleaning.sanity_filter(bronze_events if deduplicated else cleaning.dedup_events(bronze_events))
    if check_heading:
        events = cleaning.heading_filter(events)
    events = cleaning.drop_bad_enums(events) if drop_invalid_enums else cleaning.remap_bad_enums(events)
    if monotonic_odometer or sessions:
        # these read their input twice (slices and their summaries): the deduplicated events are written once
        events = store(events, "cleaned")
    if monotonic_odometer:
        events = trips.monotonic_odometer(events)
    if sessions:
        events = trips.with_session_id(events)
    return conform(events.withColumn("event_date", event_date(F.col("ts"))), SILVER_EVENTS)


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver_events: str, silver_trips: str | None = None, **options
) -> None:
    """Write Silver events, then the trip summary from what was written (if asked for)."""
    writers.write_silver_events(clean(readers.read_raw_events(spark, bronze), **options), silver_events)
    if silver_trips is not None:
        events = readers.read_table(spark, silver_events, schema=SILVER_EVENTS)
        writers.write_trips(conform(trips.trip_summary(events), SILVER_TRIPS), silver_trips)


def silver_to_gold(
    spark: SparkSession,
    silver_events: str,
    gold: str,
    silver_trips: str | None = None,
    manifests: str | None = None,
    limit_unit: str = "raw",
) -> DataFrame:
    """Write the driver features, with the trips' distance where a trip table exists."""
    events = readers.read_table(spark, silver_events, schema=SILVER_EVENTS)
    trip_table = (
        readers.optional(readers.read_table, spark, silver_trips) if silver_trips is not None else None
    )
    writers.write_gold(features.driver_features(events, trip_table, limit_unit), gold)
    written = readers.read_table(spark, gold)
    if manifests is not None:
        drivers = written.agg(F.count(F.lit(1))).scalar()
        row = writers.manifest(
            events, {"events_processed": F.count(F.lit(1))}, {"output_file": gold, "limit_unit": limit_unit}
        ).withColumn("drivers", drivers)
        writers.append_manifest(row, manifests)
    return written
