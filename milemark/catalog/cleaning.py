"""Queries for filters, projections, deduplication, set operations, sorting and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.registry import (
    CTES, _domain, bronze, gold, query, r, rounded, silver, silver_table, sql_features, training, with_ctes,
)
from milemark.operators import cleaning, labels, ordered, trips, validation
from milemark.schemas import CLEANED_ENUMS, DRIVER_FEATURES, ENUM_DOMAINS, EVENTS, SILVER_EVENTS, conform

KEYS = ["event_id", "driver_id", "trip_id", "ts"]
READINGS = ["lat", "lon", "speed_mps", "accel_mps2"]


@query("wn1_keep_first", with_ctes("SELECT * FROM bronze", "bronze"))
def wn1(spark, sf):
    return bronze(spark, sf)


@query(
    "flt1_sanity",
    with_ctes("SELECT event_id, driver_id, trip_id, ts, lat, lon, speed_mps, accel_mps2 FROM sane", "sane"),
)
def flt1(spark, sf):
    return cleaning.sanity_filter(bronze(spark, sf)).select(*KEYS, *READINGS)


@query(
    "flt2_heading",
    with_ctes(
        """SELECT event_id, ingestion_ts, heading FROM telemetry
           WHERE heading IS NULL OR (heading >= 0 AND heading < 360)""",
        "telemetry",
    ),
)
def flt2(spark, sf):
    return cleaning.heading_filter(inputs.telemetry(spark, sf)).select("event_id", "ingestion_ts", "heading")


@query(
    "flt3_enums_dropped",
    with_ctes(f"SELECT event_id, driver_id, trip_id, ts, {', '.join(CLEANED_ENUMS)} FROM silver", "silver"),
)
def flt3(spark, sf):
    return silver(spark, sf).select(*KEYS, *CLEANED_ENUMS)


_REMAPPED = ", ".join(
    f"CASE WHEN {c} IS NULL OR {c} IN ({_domain(c)}) THEN {c} ELSE 'OTHER' END AS {c}" for c in CLEANED_ENUMS
)


@query("flt4_enums_remapped", with_ctes(f"SELECT event_id, {_REMAPPED} FROM bronze", "bronze"))
def flt4(spark, sf):
    return cleaning.remap_bad_enums(bronze(spark, sf)).select("event_id", *CLEANED_ENUMS)


@query(
    "flt5_claimants",
    with_ctes(f"SELECT driver_id, {r('claim_amount')} AS claim_amount FROM training WHERE claim_occurred", "training"),
)
def flt5(spark, sf):
    return rounded(cleaning.claimants(training(spark, sf)).select("driver_id", "claim_amount"))


@query(
    "flt6_over_known_limit",
    with_ctes(
        """SELECT event_id, driver_id, trip_id, ts, speed_mps, posted_speed_limit FROM bronze
           WHERE posted_speed_limit IS NOT NULL AND speed_mps > posted_speed_limit""",
        "bronze",
    ),
)
def flt6(spark, sf):
    return cleaning.over_known_limit(bronze(spark, sf)).select(*KEYS, "speed_mps", "posted_speed_limit")


_GIVEN = {
    "event_id", "driver_id", "trip_id", "ts", "ingestion_ts", "event_seq_no", "lat", "lon", "speed_mps",
    "accel_mps2", "gyro", "heading", "odometer_km", "source", "driver_age_band", "vehicle_model_year",
    "safety_rating", "vehicle_type", "ownership_type", "weather", "road_type", "posted_speed_limit",
    "crime_index", "accident_index",
}
_SILVER_SELECT = ", ".join(
    "strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS event_date"
    if f.name == "event_date"
    else f.name
    if f.name in _GIVEN
    else f"NULL AS {f.name}"
    for f in SILVER_EVENTS.fields
)


@query("prj1_conform", with_ctes(f"SELECT {_SILVER_SELECT} FROM silver", "silver"))
def prj1(spark, sf):
    from milemark.functions.driving import event_date

    return conform(silver(spark, sf).withColumn("event_date", event_date(F.col("ts"))), SILVER_EVENTS)


@query(
    "prj2_unified_labels",
    with_ctes(
        f"""SELECT driver_id, claim_occurred AS had_claim_within_30d, {r('claim_amount')} AS claim_severity
            FROM training""",
        "training",
    ),
)
def prj2(spark, sf):
    unified = cleaning.unify_label_names(training(spark, sf))
    return rounded(unified.select("driver_id", "had_claim_within_30d", "claim_severity"))


@query(
    "prj3_resolved_labels",
    with_ctes(
        f"""SELECT driver_id, claim_occurred AS claim, {r('claim_amount')} AS amount,
            'had_claim_within_30d' AS claim_column, 'claim_amount' AS amount_column FROM training""",
        "training",
    ),
)
def prj3(spark, sf):
    both = training(spark, sf).withColumn("had_claim_within_30d", F.col("claim_occurred"))
    claim, amount = cleaning.label_columns(both.columns)
    return rounded(
        both.select(
            "driver_id", F.col(claim).alias("claim"), F.col(amount).alias("amount"),
            F.lit(claim).alias("claim_column"), F.lit(amount).alias("amount_column"),
        )
    )


@query(
    "prj4_feature_frame",
    with_ctes(f"SELECT {sql_features().removeprefix('driver_id, ')} FROM training", "training"),
)
def prj4(spark, sf):
    return rounded(cleaning.feature_frame(training(spark, sf)))


@query(
    "prj5_to_number",
    with_ctes(
        """SELECT event_id, ingestion_ts, try_cast(t AS double) AS limit_number FROM (SELECT *,
             CASE WHEN posted_speed_limit IS NULL THEN weather ELSE cast(posted_speed_limit AS varchar) END AS t
             FROM telemetry)""",
        "telemetry",
    ),
)
def prj5(spark, sf):
    from milemark.functions.driving import to_number

    mixed = F.coalesce(F.col("posted_speed_limit").cast("string"), F.col("weather"))
    return inputs.telemetry(spark, sf).select("event_id", "ingestion_ts", to_number(mixed).alias("limit_number"))


@query(
    "prj6_zero_filled",
    with_ctes(
        """SELECT event_id, ingestion_ts, coalesce(accel_mps2, 0) AS accel_mps2,
           coalesce(posted_speed_limit, 0) AS posted_speed_limit FROM telemetry""",
        "telemetry",
    ),
)
def prj6(spark, sf):
    return inputs.telemetry(spark, sf).select("event_id", "ingestion_ts", "accel_mps2", "posted_speed_limit").fillna(0)


@query(
    "prj7_null_safe_float",
    with_ctes(
        """SELECT event_id, ingestion_ts, NULL::double AS from_text, heading AS from_number,
           event_seq_no::double AS from_integer FROM telemetry""",
        "telemetry",
    ),
)
def prj7(spark, sf):
    """Numeric text is no number."""
    from milemark.functions.driving import float_or_null

    events = inputs.telemetry(spark, sf).withColumn("text", F.col("event_seq_no").cast("string"))
    return events.select(
        "event_id", "ingestion_ts", float_or_null(events, "text").alias("from_text"),
        float_or_null(events, "heading").alias("from_number"),
        float_or_null(events, "event_seq_no").alias("from_integer"),
    )


REASON_SQL = f"""CASE
  WHEN event_id IS NULL OR driver_id IS NULL OR trip_id IS NULL OR ts IS NULL OR ingestion_ts IS NULL
    OR event_seq_no IS NULL OR odometer_km IS NULL OR source IS NULL OR source NOT IN ({_domain('source')})
    THEN 'SCHEMA_VALIDATION_FAILED'
  WHEN lat IS NULL OR lon IS NULL THEN 'MISSING_LAT_LON'
  WHEN lat < -90 OR lat > 90 OR lon < -180 OR lon > 180 THEN 'LAT_LON_OUT_OF_RANGE'
  WHEN speed_mps IS NULL OR speed_mps < 0 THEN 'NEGATIVE_SPEED'
  WHEN abs(accel_mps2) > 10 THEN 'ACCEL_OUT_OF_RANGE'
  WHEN heading < 0 OR heading >= 360 THEN 'HEADING_OUT_OF_RANGE'
  WHEN driver_age_band NOT IN ({_domain('driver_age_band')}) THEN 'INVALID_DRIVER_AGE_BAND'
  WHEN vehicle_type NOT IN ({_domain('vehicle_type')}) THEN 'INVALID_VEHICLE_TYPE'
  WHEN ownership_type NOT IN ({_domain('ownership_type')}) THEN 'INVALID_OWNERSHIP_TYPE'
  WHEN weather NOT IN ({_domain('weather')}) THEN 'INVALID_WEATHER'
  WHEN road_type NOT IN ({_domain('road_type')}) THEN 'INVALID_ROAD_TYPE'
  WHEN safety_rating < 0 OR safety_rating > 5 THEN 'INVALID_SAFETY_RATING'
  WHEN vehicle_model_year < 1980 OR vehicle_model_year > 2025 THEN 'INVALID_MODEL_YEAR'
  WHEN crime_index < 0 THEN 'INVALID_CRIME_INDEX'
  WHEN accident_index < 0 THEN 'INVALID_ACCIDENT_INDEX'
  ELSE 'OK' END"""


@query(
    "val1_first_failure",
    with_ctes(f"SELECT event_id, ingestion_ts, {REASON_SQL} AS reason FROM telemetry", "telemetry"),
)
def val1(spark, sf):
    return validation.validate(inputs.telemetry(spark, sf)).select("event_id", "ingestion_ts", "reason")


@query(
    "val2_routed",
    with_ctes(
        f"""SELECT route, _dlq_reason, count(*) AS n FROM (
              SELECT CASE WHEN reason = 'OK' THEN 'bronze' ELSE 'dlq' END AS route,
                CASE WHEN reason <> 'OK' THEN reason END AS _dlq_reason
              FROM (SELECT {REASON_SQL} AS reason FROM telemetry)) GROUP BY ALL""",
        "telemetry",
    ),
)
def val2(spark, sf):
    good, bad = validation.route(validation.validate(inputs.telemetry(spark, sf)))
    sides = good.select(F.lit("bronze").alias("route"), F.lit(None).cast("string").alias("_dlq_reason")).unionByName(
        bad.select(F.lit("dlq").alias("route"), "_dlq_reason")
    )
    return sides.groupBy("route", "_dlq_reason").agg(F.count(F.lit(1)).alias("n"))


_MISSING = ",".join(f.name for f in SILVER_EVENTS.fields if f.name not in _GIVEN)


@query(
    "val3_silver_report",
    with_ctes(
        f"""SELECT count(*) AS row_count, count(*) FILTER (speed_mps < 0) AS bad_speed,
            count(*) FILTER (lat < -90 OR lat > 90) AS bad_lat, count(*) FILTER (lon < -180 OR lon > 180) AS bad_lon,
            count(*) FILTER (source NOT IN ({_domain('source')})) AS bad_source_rows,
            '{_MISSING}' AS missing_columns FROM bronze""",
        "bronze",
    ),
)
def val3(spark, sf):
    return validation.silver_report(bronze(spark, sf))


@query(
    "val3_illegal_sources",
    with_ctes(
        f"SELECT source, count(*) AS rows FROM bronze WHERE source NOT IN ({_domain('source')}) GROUP BY source", "bronze"
    ),
)
def val3_sources(spark, sf):
    return validation.illegal_sources(bronze(spark, sf))


_DOMAIN_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, {c} IN ({_domain(c)}) AS legal, count(*) AS rows "
    f"FROM telemetry WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ["source", *CLEANED_ENUMS]
)


@query("val4_domains", with_ctes(_DOMAIN_ROWS, "telemetry"))
def val4(spark, sf):
    return validation.domain_report(inputs.telemetry(spark, sf))


_NULL_ROWS = " UNION ALL ".join(
    f"SELECT '{f.name}' AS \"column\", {str(not f.nullable).lower()} AS required, "
    f"count(*) FILTER ({f.name} IS NULL) AS nulls, "
    f"{str(f.nullable).lower()} OR count(*) FILTER ({f.name} IS NULL) = 0 AS ok FROM telemetry"
    for f in EVENTS.fields
    if f.name in _GIVEN
)


@query("val4_nullability", with_ctes(_NULL_ROWS, "telemetry"))
def val4_nulls(spark, sf):
    return validation.null_report(inputs.telemetry(spark, sf))


_FOUND_SQL = "any_value(CASE typeof({c}) WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END)"
_CONTRACT_ROWS = " UNION ALL ".join(
    f"SELECT '{f.name}' AS \"column\", '{'optional' if f.nullable else 'required'}' AS kind, "
    f"{str(f.name in _GIVEN).lower()} AS present, '{f.dataType.simpleString()}' AS expected_type, "
    + (
        f"{_FOUND_SQL.format(c=f.name)} AS found_type, {_FOUND_SQL.format(c=f.name)} = '{f.dataType.simpleString()}' "
        if f.name in _GIVEN
        else "NULL AS found_type, false "
    )
    + "AS type_ok, "
    + (f"'{','.join(ENUM_DOMAINS[f.name])}'" if f.name in ENUM_DOMAINS else "NULL")
    + " AS domain, "
    + (f"count(*) FILTER ({f.name} IS NULL)" if f.name in _GIVEN else "NULL")
    + (" AS nulls FROM telemetry" if f.name in _GIVEN else " AS nulls")
    for f in EVENTS.fields
)


@query("val4_contract", with_ctes(_CONTRACT_ROWS, "telemetry"))
def val4_contract(spark, sf):
    return validation.contract_report(inputs.telemetry(spark, sf))


@query(
    "val5_training_consistency",
    with_ctes(
        """SELECT rows_data, rows_manifest, positives_data, positives_manifest,
             rows_data = rows_manifest AS rows_ok, positives_data = positives_manifest AS positives_ok
           FROM (SELECT count(*) AS rows_data, (SELECT count(*) FROM gold) AS rows_manifest,
                   count(*) FILTER (claim_occurred) AS positives_data,
                   count(*) FILTER (claim_occurred) + 1 AS positives_manifest FROM training)""",
        "training",
    ),
)
def val5(spark, sf):
    data = training(spark, sf)
    declared = labels.training_totals(data).select("rows", (F.col("positives") + 1).alias("positives"))
    return validation.training_consistency(data, declared)


_RULES = " UNION ALL ".join(
    [
        f"SELECT '{c} in [0,1]' AS rule, count(*) FILTER ({c} < 0 OR {c} > 1) AS violations, "
        f"count(*) FILTER ({c} < 0 OR {c} > 1) = 0 AS ok FROM spoiled"
        for c in validation.RATE_COLUMNS
    ]
    + [
        f"SELECT '{c} >= 0' AS rule, count(*) FILTER ({c} < 0) AS violations, "
        f"count(*) FILTER ({c} < 0) = 0 AS ok FROM spoiled"
        for c in validation.NON_NEGATIVE_COLUMNS
    ]
)


CTES["spoiled"] = (
    ["gold"],
    """SELECT * REPLACE (harsh_brake_rate + (driver_id LIKE '%7')::int AS harsh_brake_rate,
         overspeed_rate - 2 * (driver_id LIKE '%11')::int AS overspeed_rate,
         CASE WHEN driver_id LIKE '%3' THEN -1 - total_km ELSE total_km END AS total_km) FROM gold""",
)


def spoiled_gold(spark, sf):
    """Features that break some of the rules, each for other drivers."""
    ends = F.col("driver_id").endswith
    return gold(spark, sf).withColumns(
        {
            "harsh_brake_rate": F.col("harsh_brake_rate") + ends("7").cast("int"),
            "overspeed_rate": F.col("overspeed_rate") - 2 * ends("11").cast("int"),
            "total_km": F.when(ends("3"), -1 - F.col("total_km")).otherwise(F.col("total_km")),
        }
    )


@query("val6_gold_rules", with_ctes(_RULES, "spoiled"))
def val6(spark, sf):
    return validation.gold_rules(spoiled_gold(spark, sf))


@query(
    "jn6_domain_membership",
    with_ctes(
        """SELECT 'known' AS side, count(*) AS n FROM telemetry
             WHERE driver_id IN (SELECT driver_id FROM device_keys)
           UNION ALL SELECT 'unknown', count(*) FROM telemetry
             WHERE driver_id NOT IN (SELECT driver_id FROM device_keys)""",
        "telemetry", "device_keys",
    ),
)
def jn6(spark, sf):
    events = inputs.telemetry(spark, sf).select("driver_id")
    known = inputs.device_keys(spark, sf).select(F.col("driver_id").alias("device"))

    def count(df, side):
        return df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"))

    return count(cleaning.values_in_domain(events, "driver_id", known, "device"), "known").unionByName(
        count(cleaning.values_outside_domain(events, "driver_id", known, "device"), "unknown")
    )


@query(
    "st1_union_aligned",
    with_ctes(
        """SELECT origin, count(*) AS n, count(heading) AS headings, count(device) AS devices FROM (
             SELECT 'telemetry' AS origin, heading, NULL AS device FROM telemetry
             UNION ALL SELECT 'sessions', NULL, device FROM sessions_in) GROUP BY origin""",
        "telemetry", "sessions_in",
    ),
)
def st1(spark, sf):
    first = inputs.telemetry(spark, sf).withColumn("origin", F.lit("telemetry"))
    second = inputs.sessions_in(spark, sf).withColumn("origin", F.lit("sessions")).withColumn(
        "event_id", F.col("event_id").cast("string")
    )
    return cleaning.union_tables([first, second]).groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"), F.count("heading").alias("headings"), F.count("device").alias("devices")
    )


@query(
    "st2_illegal_values",
    with_ctes(
        f"SELECT DISTINCT source AS value FROM telemetry WHERE source NOT IN ({_domain('source')})", "telemetry"
    ),
)
def st2(spark, sf):
    return cleaning.illegal_symbols(inputs.telemetry(spark, sf), "source")


@query(
    "or1_ordered_events",
    with_ctes(
        """SELECT event_id, driver_id, trip_id, ts,
             row_number() OVER (PARTITION BY driver_id, trip_id ORDER BY ts, event_seq_no, event_id) AS place
           FROM silver""",
        "silver",
    ),
)
def or1(spark, sf):
    """Order within each trip; the place makes the order visible in an unordered comparison."""
    order = ["ts", "event_seq_no", "event_id"]
    return ordered.place_in_order(silver_table(spark, sf), trips.TRIP_KEYS, order).select(*KEYS, "place")


@query(
    "or3_first_rows",
    with_ctes(f"SELECT {sql_features()} FROM gold ORDER BY driver_id LIMIT 100", "gold"),
)
def or3(spark, sf):
    return rounded(cleaning.first_rows(conform(gold(spark, sf), DRIVER_FEATURES), ["driver_id"], 100))


@query(
    "wn4_sessions",
    with_ctes(
        """SELECT event_id, driver_id, ts, sum(opens) OVER (PARTITION BY driver_id ORDER BY ts, event_id
             ROWS UNBOUNDED PRECEDING)::bigint AS session_seq
           FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY driver_id ORDER BY ts, event_id) > 21600000
             OR lag(ts) OVER (PARTITION BY driver_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS opens
             FROM sessions_in)""",
        "sessions_in",
    ),
)
def wn4(spark, sf):
    return ordered.sessionize(inputs.sessions_in(spark, sf), max_gap_ms=21_600_000).select(
        "event_id", "driver_id", "ts", "session_seq"
    )


@query(
    "wn4_session_ids",
    with_ctes(
        """SELECT event_id, concat(driver_id, '-s', sum(opens) OVER (PARTITION BY driver_id
             ORDER BY ts, event_seq_no, event_id ROWS UNBOUNDED PRECEDING)::bigint::varchar) AS session_id
           FROM (SELECT *, CASE WHEN ts - lag(ts) OVER w <= 300000 THEN 0 ELSE 1 END AS opens
             FROM silver WINDOW w AS (PARTITION BY driver_id ORDER BY ts, event_seq_no, event_id))""",
        "silver",
    ),
)
def wn4_ids(spark, sf):
    return trips.with_session_id(silver_table(spark, sf)).select("event_id", "session_id")


_REACHED = """SELECT event_id, driver_id, trip_id, odometer_km, coalesce(odometer_km < max(odometer_km) OVER (
  PARTITION BY driver_id, trip_id ORDER BY ts, event_seq_no, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS odometer_backwards FROM silver"""


@query("wn5_odometer_flags", with_ctes(_REACHED, "silver"))
def wn5(spark, sf):
    return trips.flag_odometer(silver_table(spark, sf)).select(
        "event_id", "driver_id", "trip_id", "odometer_km", "odometer_backwards"
    )


@query(
    "wn5_monotonic_odometer",
    with_ctes(f"SELECT event_id, odometer_km FROM ({_REACHED}) WHERE NOT odometer_backwards", "silver"),
)
def wn5_dropped(spark, sf):
    return trips.monotonic_odometer(silver_table(spark, sf)).select("event_id", "odometer_km")
