"""Per-driver features from cleaned events and trip summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milemark.functions import driving
from milemark.schemas import DRIVER_FEATURES, conform


def with_flags(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """Add the five per-event flags and the calendar columns they use."""
    ts, accel = F.col("ts"), F.col("accel_mps2")
    return events.withColumns(
        {
            "hour": driving.hour_of_day(ts),
            "weekday": driving.weekday(ts),
            "is_harsh_brake": driving.is_harsh_brake(accel),
            "is_harsh_accel": driving.is_harsh_accel(accel),
            "is_overspeed": driving.is_overspeed(
                F.col("speed_mps"), F.col("posted_speed_limit"), limit_unit=limit_unit
            ),
            "is_night": driving.is_night(ts),
            "is_weekend": driving.is_weekend(ts),
        }
    )


def driver_event_features(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """Everything but the distance. The distinct trip count makes Spark aggregate by (driver, trip)
    before it shuffles by driver, so a driver with very many events is no bottleneck."""
    flagged = with_flags(events.filter(F.col("driver_id").isNotNull()), limit_unit)
    return flagged.groupBy("driver_id").agg(
        F.count_distinct("trip_id").alias("trip_count"),
        F.count("event_id").alias("total_events"),
        F.avg("speed_mps").alias("avg_speed_mps"),
        F.stddev_samp("speed_mps").alias("speed_std"),
        driving.share(F.col("is_harsh_brake")).alias("harsh_brake_rate"),
        driving.share(F.col("is_harsh_accel")).alias("harsh_accel_rate"),
        driving.share(F.col("is_overspeed")).alias("overspeed_rate"),
        driving.share(F.col("is_night")).alias("night_trip_ratio"),
        driving.share(F.col("is_weekend")).alias("weekend_trip_ratio"),
    )


def total_km_from_trips(trips: DataFrame) -> DataFrame:
    """Sum of trip distances; a driver whose distances are all unknown has driven 0 km."""
    return (
        trips.filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(F.coalesce(F.sum("trip_distance_km"), F.lit(0.0)).alias("total_km"))
    )


def total_km_from_odometer(events: DataFrame) -> DataFrame:
    """Fallback without trips: span of the odometer."""
    return (
        events.filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg((F.max("odometer_km") - F.min("odometer_km")).alias("total_km"))
    )


def add_total_km(features: DataFrame, km: DataFrame) -> DataFrame:
    return features.join(km, "driver_id", "left")


_RATES = {
    "harsh_brake_rate": "is_harsh_brake",
    "harsh_accel_rate": "is_harsh_accel",
    "overspeed_rate": "is_overspeed",
    "night_trip_ratio": "is_night",
    "weekend_trip_ratio": "is_weekend",
}


def driver_features_in_one_pass(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """The same table straight from the events: sums per trip, rolled up per driver.

    The events are read and shuffled once, and the distance needs no join. Speeds keep count, mean
    and squared deviations per trip, which add up to the driver's deviation.
    """
    flagged = with_flags(events.filter(F.col("driver_id").isNotNull()), limit_unit)
    per_trip = flagged.groupBy("driver_id", "trip_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("event_id").alias("events"),
        F.count("speed_mps").alias("n"),
        F.avg("speed_mps").alias("mean"),
        F.var_pop("speed_mps").alias("variance"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("km"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in _RATES.values()],
    )
    n, mean = F.col("n"), F.col("mean")
    totals = per_trip.groupBy("driver_id").agg(
        F.count("trip_id").alias("trip_count"),
        F.sum("events").alias("total_events"),
        F.sum("rows").alias("rows"),
        F.sum(n).alias("n"),
        F.try_divide(F.sum(n * mean), F.sum(n)).alias("avg_speed_mps"),
        F.sum(n * F.col("variance")).alias("within"),
        F.sum(n * mean * mean).alias("squares"),
        F.coalesce(F.sum(F.when(F.col("trip_id").isNotNull(), F.col("km"))), F.lit(0.0)).alias("total_km"),
        *[F.sum(flag).alias(flag) for flag in _RATES.values()],
    )
    between = F.col("squares") - n * F.col("avg_speed_mps") * F.col("avg_speed_mps")
    spread = F.col("within") + F.greatest(between, F.lit(0.0))
    return conform(
        totals.withColumns(
            {
                "speed_std": F.when(n > 1, F.sqrt(spread / (n - 1))),
                **{rate: F.col(flag) / F.col("rows") for rate, flag in _RATES.items()},
            }
        ),
        DRIVER_FEATURES,
    )


def driver_features(
    events: DataFrame, trips: DataFrame | None = None, limit_unit: str = "raw"
) -> DataFrame:
    """The Gold table: event features with the distance of the trips, or of the odometer."""
    km = total_km_from_trips(trips) if trips is not None else total_km_from_odometer(events)
    return conform(add_total_km(driver_event_features(events, limit_unit), km), DRIVER_FEATURES)
