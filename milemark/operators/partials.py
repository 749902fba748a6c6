"""Mergeable partial aggregates of trips: counts, sums, squared deviations and extremes that add up over any split of a
trip's events, and the trip summary and driver features read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.functions import driving
from milemark.operators.features import with_flags
from milemark.schemas import DRIVER_FEATURES, SILVER_TRIPS, conform

KEYS = ["driver_id", "trip_id"]
_MEASURES = ("speed_mps", "accel_mps2", "gyro")
_EXTREMES = ("ts", "speed_mps", "odometer_km")
_FLAGS = ("is_harsh_brake", "is_harsh_accel", "is_overspeed", "is_night", "is_weekend")
_TRIP_COUNTS = ("harsh_brakes", "harsh_accels", "overspeed_events")


def trip_partials(events: DataFrame, limit_unit: str = "raw") -> DataFrame:
    """One row for each (driver, trip) of these events; rows without a driver count in none."""
    accel = F.col("accel_mps2")
    limit = driving.to_number(F.col("posted_speed_limit"))
    flagged = with_flags(events.where("driver_id is not null"), limit_unit)
    return flagged.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("event_id").alias("events"),
        *[F.count(c).alias(f"{c}_n") for c in _MEASURES],
        *[F.sum(c).alias(f"{c}_sum") for c in _MEASURES],
        *[(F.var_pop(c) * F.count(c)).alias(f"{c}_m2") for c in _MEASURES],
        *[f(c).alias(f"{c}_{n}") for c in _EXTREMES for n, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(F.col(c)).alias(c) for c in _FLAGS],
        # beyond these limits here, at them in the flags
        F.count_if(accel < driving.HARSH_BRAKE_MPS2).alias("harsh_brakes"),
        F.count_if(accel > driving.HARSH_ACCEL_MPS2).alias("harsh_accels"),
        F.count_if(driving.exceeds_posted_limit(F.col("speed_mps"), limit, limit_unit)).alias("overspeed_events"),
    )


def _m2(c: str) -> Column:
    """Squared deviations of the whole: those inside the parts, and those of the parts' means."""
    n, total = F.sum(f"{c}_n"), F.sum(f"{c}_sum")
    between = F.sum(F.try_divide(F.col(f"{c}_sum") * F.col(f"{c}_sum"), F.col(f"{c}_n"))) - F.try_divide(total * total, n)
    return F.sum(f"{c}_m2") + F.greatest(between, F.lit(0.0))


def merge_partials(parts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Partials of the same keys as one."""
    counts = ["rows", "events", *[f"{c}_n" for c in _MEASURES], *[f"{c}_sum" for c in _MEASURES], *_FLAGS, *_TRIP_COUNTS]
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counts],
        *[_m2(c).alias(f"{c}_m2") for c in _MEASURES],
        *[f(f"{c}_{n}").alias(f"{c}_{n}") for c in _EXTREMES for n, f in (("min", F.min), ("max", F.max))],
    ).select(parts.columns)


def _deviation(c: str) -> Column:
    n = F.col(f"{c}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{c}_m2") / (n - 1)))


def trips_of(merged: DataFrame) -> DataFrame:
    """The trip summary of merged partials."""
    distance = F.col("odometer_km_max") - F.col("odometer_km_min")
    known = merged.where("trip_id is not null").withColumns(
        {
            "speed_mps_mean": F.try_divide(F.col("speed_mps_sum"), F.col("speed_mps_n")),
            "accel_mps2_mean": F.try_divide(F.col("accel_mps2_sum"), F.col("accel_mps2_n")),
            "gyro_std": _deviation("gyro"),
            "trip_duration_sec": driving.trip_duration_sec(F.col("ts_min"), F.col("ts_max")),
            "trip_distance_km": distance,
        }
    )
    average = driving.trip_average_speed(F.col("trip_distance_km"), F.col("trip_duration_sec"))
    return conform(known.withColumn("avg_speed_calc", average), SILVER_TRIPS)


def features_of(merged: DataFrame) -> DataFrame:
    """The driver features of merged partials: trips add up to drivers as file sets add up to trips."""
    km = F.when(F.col("trip_id").isNotNull(), F.col("odometer_km_max") - F.col("odometer_km_min"))
    drivers = merged.groupBy("driver_id").agg(
        F.count("trip_id").alias("trip_count"),
        F.sum("events").cast("long").alias("total_events"),
        F.sum("rows").alias("rows"),
        F.sum("speed_mps_n").alias("speed_mps_n"),
        F.try_divide(F.sum("speed_mps_sum"), F.sum("speed_mps_n")).alias("avg_speed_mps"),
        _m2("speed_mps").alias("speed_mps_m2"),
        # a driver without trips has no distance; unknown distances count as 0
        F.when(F.count("trip_id") > 0, F.coalesce(F.sum(km), F.lit(0.0))).alias("total_km"),
        *[F.sum(c).alias(c) for c in _FLAGS],
    )
    rates = ("harsh_brake_rate", "harsh_accel_rate", "overspeed_rate", "night_trip_ratio", "weekend_trip_ratio")
    shares = {rate: F.col(flag) / F.col("rows") for rate, flag in zip(rates, _FLAGS, strict=True)}
    return conform(drivers.withColumns({"speed_std": _deviation("speed_mps"), **shares}), DRIVER_FEATURES)
