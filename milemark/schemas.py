"""Table contracts of the telemetry lake, and ``conform`` which enforces them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal symbols of the enumerated columns (case-sensitive).
ENUM_DOMAINS: dict[str, list[str]] = {
    "source": ["phone", "OBD", "simulator"],
    "driver_age_band": ["UNDER25", "AGE_25_40", "AGE_40_60", "OVER60"],
    "vehicle_type": ["SEDAN", "SUV", "TRUCK", "MOTORCYCLE", "EV", "OTHER"],
    "ownership_type": ["OWNED", "LEASED", "FLEET"],
    "weather": ["clear", "rain", "snow", "fog", "other"],
    "road_type": ["highway", "urban", "rural"],
}

# The enumerated columns that the cleaning step checks (``source`` is only reported on).
CLEANED_ENUMS = ["driver_age_band", "vehicle_type", "ownership_type", "weather", "road_type"]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _struct(spec: str, required: tuple[str, ...] = ()) -> T.StructType:
    """``name type, …`` as a schema; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], name not in required) for name, kind in pairs])


REQUIRED_EVENT_COLUMNS = (
    "event_id", "driver_id", "trip_id", "ts", "ingestion_ts", "event_seq_no",
    "lat", "lon", "speed_mps", "odometer_km", "source",
)

_CONTEXT_DDL = """
    driver_age_band string, license_years int, accidents_count int, claims_count int,
    violation_points int, policy_tenure_years int,
    vehicle_make string, vehicle_model_year int, safety_rating float, vehicle_vin_hash string,
    vehicle_type string, ownership_type string,
    weather string, road_type string, posted_speed_limit int, crime_index float, accident_index float
"""

EVENTS = _struct(
    f"""event_id string, driver_id string, trip_id string, ts bigint, ingestion_ts bigint,
    event_seq_no int, lat double, lon double, speed_mps double, accel_mps2 double, gyro double,
    heading double, odometer_km double, source string, {_CONTEXT_DDL}""",
    REQUIRED_EVENT_COLUMNS,
)

SILVER_EVENTS = _struct(
    f"""event_id string, driver_id string, trip_id string, session_id string, ts bigint,
    ingestion_ts bigint, event_date string, event_seq_no int, lat double, lon double,
    speed_mps double, accel_mps2 double, gyro double, heading double, odometer_km double,
    source string, {_CONTEXT_DDL},
    trip_distance_km double, trip_duration_sec bigint, avg_speed_mps double,
    harsh_brake_events int, harsh_accel_events int, overspeed_events int""",
    REQUIRED_EVENT_COLUMNS + ("event_date",),
)

SILVER_TRIPS = _struct(
    """driver_id string, trip_id string, ts_min bigint, ts_max bigint, speed_mps_mean double,
    speed_mps_max double, speed_mps_min double, accel_mps2_mean double, gyro_std double,
    odometer_km_min double, odometer_km_max double, trip_duration_sec double,
    trip_distance_km double, avg_speed_calc double, harsh_brakes bigint, harsh_accels bigint,
    overspeed_events bigint""",
    ("driver_id", "trip_id"),
)

_FEATURE_DDL = """driver_id string, trip_count int, total_events int, avg_speed_mps double,
    speed_std double, harsh_brake_rate double, harsh_accel_rate double, overspeed_rate double,
    night_trip_ratio double, weekend_trip_ratio double, total_km double"""

DRIVER_FEATURES = _struct(_FEATURE_DDL, ("driver_id", "trip_count", "total_events"))

TRAINING_SET = _struct(
    _FEATURE_DDL + ", claim_occurred boolean, claim_amount double",
    ("driver_id", "trip_count", "total_events", "claim_occurred", "claim_amount"),
)

FEATURE_COLUMNS = [f.name for f in DRIVER_FEATURES.fields if f.name != "driver_id"]

PREDICTIONS = _struct("row_id bigint, y_true double, y_pred double")

MODEL_SUMMARY = _struct(
    """Model string, AUC double, PR double, Brier double, MAE double, RMSE double, R2 double,
    config_hash string, run_time string, artifact string, was_split boolean"""
)

RISK_SCORES = _struct(
    "driver_id string, p_claim_30d double, severity_pred double, expected_loss double, total_km double"
)

REGISTRY = _struct(
    """name string, version string, data_hash string, artifact string, metrics_path string,
    created_at string, phase string"""
)


def null_if_nan(column: Column | str) -> Column:
    """NaN and null mean the same thing here; Spark would sort NaN above every number."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(c), c)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: add missing columns as null, drop extras, fix order and types.

    Floating columns come out with NaN turned into null.
    """
    present = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        if field.name not in present:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c = F.col(field.name)
        if isinstance(types[field.name], (T.DoubleType, T.FloatType)):
            c = null_if_nan(c)
        if types[field.name] != field.dataType:
            c = c.cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)
