"""Trip summaries, sessions and the odometer check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.functions import driving
from milemark.operators.ordered import DEFAULT_SLICE_MS, running_max_before, sessionize

TRIP_KEYS = ["driver_id", "trip_id"]


def _with_keys(events: DataFrame) -> DataFrame:
    return events.filter(F.col("driver_id").isNotNull() & F.col("trip_id").isNotNull())


def _trip_counts(limit_unit: str) -> list[Column]:
    """Events beyond ±3 m/s² (exclusive here, unlike the driver rates) and above the posted limit."""
    accel = F.col("accel_mps2")
    limit = driving.to_number(F.col("posted_speed_limit"))
    return [
        F.count_if(accel < driving.HARSH_BRAKE_MPS2).alias("harsh_brakes"),
        F.count_if(accel > driving.HARSH_ACCEL_MPS2).alias("harsh_accels"),
        F.count_if(driving.exceeds_posted_limit(F.col("speed_mps"), limit, limit_unit)).alias("overspeed_events"),
    ]


def trip_summary(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """One row per (driver_id, trip_id). Statistics and counts share one aggregate, one shuffle."""
    summary = _with_keys(events).groupBy(*TRIP_KEYS).agg(
        F.min("ts").alias("ts_min"),
        F.max("ts").alias("ts_max"),
        F.avg("speed_mps").alias("speed_mps_mean"),
        F.max("speed_mps").alias("speed_mps_max"),
        F.min("speed_mps").alias("speed_mps_min"),
        F.avg("accel_mps2").alias("accel_mps2_mean"),
        F.stddev_samp("gyro").alias("gyro_std"),
        F.min("odometer_km").alias("odometer_km_min"),
        F.max("odometer_km").alias("odometer_km_max"),
        *_trip_counts(limit_unit),
    )
    return (
        summary.withColumn("trip_duration_sec", driving.trip_duration_sec(F.col("ts_min"), F.col("ts_max")))
        .withColumn("trip_distance_km", F.col("odometer_km_max") - F.col("odometer_km_min"))
        .withColumn(
            "avg_speed_calc", driving.trip_average_speed(F.col("trip_distance_km"), F.col("trip_duration_sec"))
        )
    )


def trip_event_counts(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """The three conditional counts alone."""
    return _with_keys(events).groupBy(*TRIP_KEYS).agg(*_trip_counts(limit_unit))


def attach_trip_counts(trips: DataFrame, counts: DataFrame, columns: list[str]) -> DataFrame:
    """Left join of per-trip counts kept in another table; a trip it lacks gets 0."""
    joined = trips.join(counts.select(*TRIP_KEYS, *columns), TRIP_KEYS, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def with_session_id(
    events: DataFrame, max_gap_seconds: int = 300, slice_ms: int = DEFAULT_SLICE_MS
) -> DataFrame:
    """Fill ``session_id`` as ``<driver>-s<n>``: a pause above the gap starts a new session."""
    numbered = sessionize(
        events, ["driver_id"], "ts", ["ts", "event_seq_no", "event_id"], max_gap_seconds * 1000, slice_ms
    )
    session = F.concat(F.col("driver_id"), F.lit("-s"), F.col("session_seq").cast("string"))
    return numbered.withColumn("session_id", session).drop("session_seq")


def flag_odometer(events: DataFrame, slice_ms: int = DEFAULT_SLICE_MS) -> DataFrame:
    """Add ``odometer_backwards``: the reading lies below an earlier one of the same trip."""
    ranked = running_max_before(events, "odometer_km", "_reached", TRIP_KEYS, slice_ms=slice_ms)
    return ranked.withColumn(
        "odometer_backwards", F.coalesce(F.col("odometer_km") < F.col("_reached"), F.lit(False))
    ).drop("_reached")


def monotonic_odometer(events: DataFrame, slice_ms: int = DEFAULT_SLICE_MS) -> DataFrame:
    """Drop the readings that ``flag_odometer`` marks."""
    return flag_odometer(events, slice_ms).filter(~F.col("odometer_backwards")).drop("odometer_backwards")


def fill_trip_columns(silver_events: DataFrame, trips: DataFrame) -> DataFrame:
    """Fill the Silver events' trip columns, otherwise null, from the trip summary."""
    names = {
        "trip_distance_km": "trip_distance_km",
        "trip_duration_sec": "trip_duration_sec",
        "speed_mps_mean": "avg_speed_mps",
        "harsh_brakes": "harsh_brake_events",
        "harsh_accels": "harsh_accel_events",
        "overspeed_events": "overspeed_events",
    }
    types = {f.name: f.dataType for f in silver_events.schema.fields}
    per_trip = trips.select(*TRIP_KEYS, *[F.col(k).cast(types[v]).alias(v) for k, v in names.items()])
    return (
        silver_events.drop(*names.values()).join(per_trip, TRIP_KEYS, "left").select(*silver_events.columns)
    )
