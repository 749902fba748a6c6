"""Where the catalog modules register their queries, and the SQL pieces the checks share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.operators import cleaning, features, labels, trips
from milemark.schemas import CLEANED_ENUMS, ENUM_DOMAINS
from milemark.session import store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent for the checking engine, if there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all doubles: sums depend on the order of their terms in the last bits."""
    return df.select(
        *[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def r(expression: str, digits: int = 6) -> str:
    """The same in SQL; adding 0 turns -0.0 into 0.0."""
    return f"(round({expression}, {digits}) + 0)"


# --- the layers in Spark ---


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedup_events(inputs.telemetry(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_bad_enums(cleaning.sanity_filter(bronze(spark, sf)))


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as later steps find it: written. Operators that pass over it more than once start here."""
    return store(silver(spark, sf), "silver")


def silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trip_summary(silver(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return features.driver_features_in_one_pass(silver(spark, sf))


def training(spark: SparkSession, sf: str) -> DataFrame:
    return labels.training_set(gold(spark, sf))


def gold_table(spark: SparkSession, sf: str) -> DataFrame:
    return store(gold(spark, sf), "gold")


def training_table(spark: SparkSession, sf: str) -> DataFrame:
    return store(training(spark, sf), "training")


# --- the same layers as common table expressions ---


def _domain(column: str) -> str:
    return ", ".join(f"'{v}'" for v in ENUM_DOMAINS[column])


def sql_uniform(key: str, seed: int, tag: str) -> str:
    digest = f"md5(concat_ws('|', cast({key} as varchar), '{seed}', '{tag}'))"
    return f"((cast(cast('0x' || substr({digest}, 1, 13) as bigint) as double) + 0.5) / 4503599627370496.0)"


_TELEMETRY_COLUMNS = re.findall(r"AS (\w+)[,\n]", inputs.TELEMETRY)
_FIRST_COPY = ", ".join(f"{c} ASC NULLS FIRST" for c in cleaning.copy_order(_TELEMETRY_COLUMNS))
_LEGAL = " AND ".join(f"({c} IS NULL OR {c} IN ({_domain(c)}))" for c in CLEANED_ENUMS)
_TS = "make_timestamp(ts * 1000)"

CTES: dict[str, tuple[list[str], str]] = {
    "telemetry": ([], inputs.for_duckdb(inputs.TELEMETRY)),
    "sessions_in": ([], inputs.for_duckdb(inputs.SESSIONS_IN)),
    "arrivals": ([], inputs.for_duckdb(inputs.ARRIVALS)),
    "class_preds": ([], inputs.for_duckdb(inputs.CLASS_PREDS)),
    "reg_preds": ([], inputs.for_duckdb(inputs.REG_PREDS)),
    "risk_in": ([], inputs.for_duckdb(inputs.RISK_IN)),
    "device_keys": ([], inputs.for_duckdb(inputs.DEVICE_KEYS)),
    "registry_in": ([], inputs.for_duckdb(inputs.REGISTRY_IN)),
    "request_events": ([], inputs.for_duckdb(inputs.REQUEST_EVENTS)),
    "bronze": (
        ["telemetry"],
        f"""SELECT * EXCLUDE (copy_no) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_FIRST_COPY}) AS copy_no
            FROM telemetry) WHERE copy_no = 1""",
    ),
    "sane": (
        ["bronze"],
        """SELECT * FROM bronze WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
            AND speed_mps BETWEEN 0 AND 80 AND accel_mps2 BETWEEN -12 AND 12""",
    ),
    "silver": (["sane"], f"SELECT * FROM sane WHERE {_LEGAL}"),
    "trips": (
        ["silver"],
        """SELECT *, (ts_max - ts_min) / 1000.0::double AS trip_duration_sec,
              odometer_km_max - odometer_km_min AS trip_distance_km,
              (odometer_km_max - odometer_km_min)
                / ((ts_max - ts_min) / 1000.0::double / 3600.0::double + 0.000001::double) AS avg_speed_calc
            FROM (SELECT driver_id, trip_id, min(ts) AS ts_min, max(ts) AS ts_max,
              avg(speed_mps) AS speed_mps_mean, max(speed_mps) AS speed_mps_max, min(speed_mps) AS speed_mps_min,
              avg(accel_mps2) AS accel_mps2_mean, stddev_samp(gyro) AS gyro_std,
              min(odometer_km) AS odometer_km_min, max(odometer_km) AS odometer_km_max,
              count(*) FILTER (accel_mps2 < -3) AS harsh_brakes,
              count(*) FILTER (accel_mps2 > 3) AS harsh_accels,
              count(*) FILTER (posted_speed_limit IS NOT NULL AND speed_mps > posted_speed_limit) AS overspeed_events
            FROM silver WHERE driver_id IS NOT NULL AND trip_id IS NOT NULL GROUP BY driver_id, trip_id)""",
    ),
    "flagged": (
        ["silver"],
        f"""SELECT *, hour({_TS}) AS hour, isodow({_TS}) - 1 AS weekday,
              coalesce(accel_mps2 <= -3, false) AS is_harsh_brake,
              coalesce(accel_mps2 >= 3, false) AS is_harsh_accel,
              coalesce(speed_mps > posted_speed_limit + 5 / 3.6::double, false) AS is_overspeed,
              hour({_TS}) >= 21 OR hour({_TS}) <= 5 AS is_night,
              isodow({_TS}) IN (6, 7) AS is_weekend
            FROM silver""",
    ),
    "driver_events": (
        ["flagged"],
        """SELECT driver_id, count(DISTINCT trip_id) AS trip_count, count(event_id) AS total_events,
              avg(speed_mps) AS avg_speed_mps, stddev_samp(speed_mps) AS speed_std,
              avg(is_harsh_brake::int) AS harsh_brake_rate, avg(is_harsh_accel::int) AS harsh_accel_rate,
              avg(is_overspeed::int) AS overspeed_rate, avg(is_night::int) AS night_trip_ratio,
              avg(is_weekend::int) AS weekend_trip_ratio
            FROM flagged GROUP BY driver_id""",
    ),
    "km": (
        ["trips"],
        "SELECT driver_id, coalesce(sum(trip_distance_km), 0) AS total_km FROM trips GROUP BY driver_id",
    ),
    "gold": (["driver_events", "km"], "SELECT * FROM driver_events LEFT JOIN km USING (driver_id)"),
    "probable": (
        ["gold"],
        """SELECT *, 1 / (1 + exp(-(ln(0.2::double / (1 - 0.2::double))
              + 0.6::double * coalesce(harsh_brake_rate, 0) + 0.6::double * coalesce(harsh_accel_rate, 0)
              + 0.2::double * coalesce(night_trip_ratio, 0) + 0.001::double * coalesce(trip_count, 0)))) AS p
            FROM gold""",
    ),
    "training": (
        ["probable"],
        f"""SELECT *, CASE WHEN claim_occurred THEN severity * (1 + coalesce(total_km, 0) / 1000)
              * (1 + coalesce(speed_std, 0) / 10) ELSE 0 END AS claim_amount
            FROM (SELECT *, {sql_uniform("driver_id", labels.SEED, "claim")} < p AS claim_occurred,
              -500.0::double * (ln({sql_uniform("driver_id", labels.SEED, "severity0")})
                + ln({sql_uniform("driver_id", labels.SEED, "severity1")})) AS severity
            FROM probable)""",
    ),
}


def with_ctes(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` preceded by the named expressions and everything they need, in order."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        for dependency in CTES[name][0]:
            add(dependency)
        needed.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in needed)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"


FEATURE_NAMES = [
    "trip_count", "total_events", "avg_speed_mps", "speed_std", "harsh_brake_rate", "harsh_accel_rate",
    "overspeed_rate", "night_trip_ratio", "weekend_trip_ratio", "total_km",
]


def sql_features(digits: int = 6) -> str:
    """Select list of the driver features."""
    exact = ("trip_count", "total_events")
    return "driver_id, " + ", ".join(
        f"{c}::int AS {c}" if c in exact else f"{r(c, digits)} AS {c}" for c in FEATURE_NAMES
    )
