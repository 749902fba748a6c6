"""Column expressions on telemetry readings: UTC calendar parts, driving flags, trip arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thresholds of the driver features.
HARSH_BRAKE_MPS2 = -3.0
HARSH_ACCEL_MPS2 = 3.0
OVERSPEED_MARGIN_KMH = 5.0
NIGHT_START_HOUR = 21
NIGHT_END_HOUR = 5
WEEKEND_DAYS = [5, 6]  # Monday = 0

MS_PER_DAY = 86_400_000


def instant(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def event_date(ts_ms: Column) -> Column:
    """UTC day of an epoch-millisecond instant, ``yyyy-MM-dd``."""
    return F.date_format(instant(ts_ms), "yyyy-MM-dd")


def hour_of_day(ts_ms: Column) -> Column:
    return F.hour(instant(ts_ms))


def weekday(ts_ms: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(instant(ts_ms))


def is_night(ts_ms: Column, start: int = NIGHT_START_HOUR, end: int = NIGHT_END_HOUR) -> Column:
    """From ``start`` o'clock to the end of hour ``end``, across midnight."""
    hour = hour_of_day(ts_ms)
    return (hour >= start) | (hour <= end)


def is_weekend(ts_ms: Column, days: list[int] = WEEKEND_DAYS) -> Column:
    return weekday(ts_ms).isin(days)


def is_harsh_brake(accel: Column, limit: float = HARSH_BRAKE_MPS2) -> Column:
    return F.coalesce(accel <= limit, F.lit(False))


def is_harsh_accel(accel: Column, limit: float = HARSH_ACCEL_MPS2) -> Column:
    return F.coalesce(accel >= limit, F.lit(False))


def limit_in_speed_unit(limit: Column, limit_unit: str) -> Column:
    """``raw`` compares the posted number as it stands; ``kmh`` converts it to m/s first."""
    if limit_unit == "raw":
        return limit.cast("double")
    if limit_unit == "kmh":
        return limit / 3.6
    raise ValueError(f"limit_unit must be 'raw' or 'kmh', not {limit_unit!r}")


def is_overspeed(
    speed: Column, limit: Column, margin_kmh: float = OVERSPEED_MARGIN_KMH, limit_unit: str = "raw"
) -> Column:
    """An unknown limit is never exceeded."""
    return F.coalesce(speed > limit_in_speed_unit(limit, limit_unit) + margin_kmh / 3.6, F.lit(False))


def exceeds_posted_limit(speed: Column, limit: Column, limit_unit: str = "raw") -> Column:
    """Without margin, as the trip summary counts it."""
    return F.coalesce(speed > limit_in_speed_unit(limit, limit_unit), F.lit(False))


def trip_duration_sec(ts_min: Column, ts_max: Column) -> Column:
    return (ts_max - ts_min) / 1000.0


def trip_average_speed(distance_km: Column, duration_sec: Column) -> Column:
    """km/h; the small constant keeps a trip of no duration finite."""
    return distance_km / (duration_sec / 3600.0 + 1e-6)


def share(flag: Column) -> Column:
    """Aggregate: fraction of rows where ``flag`` holds; a null flag counts as false."""
    return F.avg(F.coalesce(flag, F.lit(False)).cast("int"))


def to_number(column: Column) -> Column:
    """Anything that is not a number becomes null."""
    return column.try_cast("double")


def float_or_null(df: DataFrame, column: str) -> Column:
    """A number as double; anything else, numeric text included, becomes null."""
    number = isinstance(df.schema[column].dataType, T.NumericType)
    return F.col(column).cast("double") if number else F.lit(None).cast("double")
