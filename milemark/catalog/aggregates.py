"""Queries for trip, driver and distribution aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.registry import (
    FEATURE_NAMES, gold, gold_table, query, r, rounded, silver, silver_table, silver_trips, sql_features,
    training,
    training_table, with_ctes,
)
from milemark.operators import distribution, features, labels, monitoring, trips
from milemark.plans import profiles
from milemark.schemas import SILVER_TRIPS, conform
from milemark.session import scratch_path, store

_TRIP_NUMBERS = [
    "ts_min", "ts_max", "speed_mps_mean", "speed_mps_max", "speed_mps_min", "accel_mps2_mean", "gyro_std",
    "odometer_km_min", "odometer_km_max", "trip_duration_sec", "trip_distance_km",
]
_TRIP_COUNTS = ["harsh_brakes", "harsh_accels", "overspeed_events"]


def sql_trip_columns() -> str:
    numbers = ", ".join(c if c.startswith("ts_") else f"{r(c)} AS {c}" for c in _TRIP_NUMBERS)
    return f"driver_id, trip_id, {numbers}, {r('avg_speed_calc', 4)} AS avg_speed_calc, {', '.join(_TRIP_COUNTS)}"


def rounded_trips(df):
    return rounded(conform(df, SILVER_TRIPS).withColumn("avg_speed_calc", F.round("avg_speed_calc", 4)))


@query("ag1_trip_summary", with_ctes(f"SELECT {sql_trip_columns()} FROM trips", "trips"))
def ag1(spark, sf):
    return rounded_trips(silver_trips(spark, sf))


@query(
    "ag2_trip_counts",
    with_ctes(f"SELECT driver_id, trip_id, {', '.join(_TRIP_COUNTS)} FROM trips", "trips"),
)
def ag2(spark, sf):
    return trips.trip_event_counts(silver(spark, sf))


@query("ag3_driver_features", with_ctes(f"SELECT {sql_features()} FROM gold", "gold"))
def ag3(spark, sf):
    return rounded(gold(spark, sf))


@query("ag3_driver_features_with_trips", with_ctes(f"SELECT {sql_features()} FROM gold", "gold"))
def ag3_trips(spark, sf):
    """From a separate trip table, as when Silver was written earlier."""
    events = silver_table(spark, sf)
    return rounded(features.driver_features(events, trips.trip_summary(events)))


@query("ag4_total_km", with_ctes(f"SELECT driver_id, {r('total_km')} AS total_km FROM km", "km"))
def ag4(spark, sf):
    return rounded(features.total_km_from_trips(silver_trips(spark, sf)))


_ODOMETER_KM = "SELECT driver_id, max(odometer_km) - min(odometer_km) AS total_km FROM silver GROUP BY driver_id"


@query("ag5_odometer_km", with_ctes(_ODOMETER_KM, "silver"))
def ag5(spark, sf):
    return features.total_km_from_odometer(silver(spark, sf))


@query(
    "ag6_training_totals",
    with_ctes(
        f"""SELECT count(*) AS rows, count(*) FILTER (claim_occurred) AS positives,
            {r('avg(claim_occurred::int)')} AS claim_rate, {r('avg(claim_amount)')} AS mean_severity,
            {r('max(claim_amount)')} AS max_severity FROM training""",
        "training",
    ),
)
def ag6(spark, sf):
    return rounded(labels.training_totals(training(spark, sf)))


@query(
    "ag7_claim_kpis",
    with_ctes(
        f"""SELECT count(*) AS samples, {r('avg(claim_occurred::int)')} AS claim_rate,
            count(*) FILTER (claim_occurred) AS claims,
            {r('avg(claim_amount) FILTER (claim_occurred)')} AS mean_severity FROM training""",
        "training",
    ),
)
def ag7(spark, sf):
    return rounded(monitoring.claim_kpis(training(spark, sf)))


_PREMIUMS = """SELECT driver_id, least(greatest(p_raw, 0), 1) * greatest(severity_raw, 0) * 1.35::double AS premium
  FROM risk_in"""


@query(
    "ag8_premium_kpis",
    with_ctes(
        f"""SELECT count(DISTINCT driver_id) AS drivers, {r('avg(premium)')} AS mean_premium,
            count(*) FILTER (premium > 1.5::double * (SELECT quantile_cont(premium, 0.5) FROM ({_PREMIUMS})))
            AS high_risk FROM ({_PREMIUMS})""",
        "risk_in",
    ),
)
def ag8(spark, sf):
    scores = labels.with_expected_loss(labels.clip_scores(inputs.risk_in(spark, sf)))
    return rounded(monitoring.premium_kpis(labels.with_premium(scores)))


@query(
    "ag9_layer_counts",
    with_ctes(
        """SELECT 'silver' AS layer, count(*) AS rows FROM silver
           UNION ALL SELECT 'gold', count(DISTINCT driver_id) FROM silver
           UNION ALL SELECT 'raw', count(*) FROM telemetry""",
        "silver",
    ),
)
def ag9(spark, sf):
    return monitoring.layer_counts(
        {"silver": silver(spark, sf), "gold": gold(spark, sf), "raw": inputs.telemetry(spark, sf)}
    )


@query(
    "ag10_activity",
    with_ctes(
        """SELECT count(*) AS events, count(DISTINCT driver_id) AS drivers,
           cast(floor((max(ts) - min(ts)) / 86400000) as bigint) AS days FROM sessions_in""",
        "sessions_in",
    ),
)
def ag10(spark, sf):
    return monitoring.activity(inputs.sessions_in(spark, sf))


@query(
    "ag10_lateness",
    with_ctes(
        f"""SELECT count(*) AS events, {r('avg(ingestion_ts - ts)')} AS mean_ms, min(ingestion_ts - ts) AS min_ms,
            max(ingestion_ts - ts) AS max_ms FROM telemetry""",
        "telemetry",
    ),
)
def ag10_lateness(spark, sf):
    return rounded(monitoring.lateness(inputs.telemetry(spark, sf)))


@query(
    "ag11_value_counts",
    with_ctes(
        f"""SELECT event_type AS value, count(*) AS n,
            {r('count(*) / (SELECT count(*) FROM sessions_in WHERE event_type IS NOT NULL)', 9)} AS share
            FROM sessions_in WHERE event_type IS NOT NULL GROUP BY event_type""",
        "sessions_in",
    ),
)
def ag11(spark, sf):
    return rounded(distribution.value_counts(inputs.sessions_in(spark, sf), "event_type"), 9)


def _long_sql(parts) -> str:
    return " UNION ALL ".join(parts)


_DESCRIBE = _long_sql(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", count(*) FILTER ({c} IS NULL) AS missing,
      {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})::double')} AS min,
      {r(f'max({c})::double')} AS max, {r(f'quantile_cont({c}::double, 0.25)')} AS q25,
      {r(f'quantile_cont({c}::double, 0.5)')} AS q50, {r(f'quantile_cont({c}::double, 0.75)')} AS q75 FROM gold"""
    for c in FEATURE_NAMES
)


@query("ag12_describe", with_ctes(_DESCRIBE, "gold"))
def ag12(spark, sf):
    return rounded(distribution.describe(gold_table(spark, sf), FEATURE_NAMES))


@query(
    "ag13_feature_means",
    with_ctes(
        _long_sql(f"SELECT '{c}' AS \"column\", {r(f'avg({c})')} AS mean FROM gold" for c in FEATURE_NAMES), "gold"
    ),
)
def ag13(spark, sf):
    return rounded(distribution.feature_means(gold(spark, sf), FEATURE_NAMES))


def sql_histogram(source: str, column: str, by: str = "", bins: int = 30) -> str:
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}least(coalesce(cast(floor(
        CASE WHEN hi > lo THEN (x - lo) * {bins} / (hi - lo) END) as bigint), 0), {bins - 1}) AS bin, count(*) AS n
      FROM (SELECT *, ({column}) AS x FROM {source}),
        (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
      WHERE x IS NOT NULL GROUP BY ALL"""


@query("ag14_histogram", with_ctes(sql_histogram("reg_preds", "y_pred"), "reg_preds"))
def ag14(spark, sf):
    return distribution.histogram(inputs.reg_preds(spark, sf), "y_pred")


@query("ag14_histogram_by_label", with_ctes(sql_histogram("class_preds", "y_pred", "y_true"), "class_preds"))
def ag14_label(spark, sf):
    return distribution.histogram(inputs.class_preds(spark, sf), "y_pred", by=["y_true"])


@query("ag14_residual_histogram", with_ctes(sql_histogram("reg_preds", "y_true - y_pred"), "reg_preds"))
def ag14_residual(spark, sf):
    from milemark.functions.actuarial import residual

    preds = inputs.reg_preds(spark, sf).withColumn("residual", residual(F.col("y_true"), F.col("y_pred")))
    return distribution.histogram(preds, "residual")


def sql_box(source: str, columns: list[str]) -> str:
    return _long_sql(
        f"""SELECT '{c}' AS "column", {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
          {r(f'min({c}) FILTER ({c} BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1))::double')}
            AS lower_whisker,
          {r(f'max({c}) FILTER ({c} BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1))::double')}
            AS upper_whisker,
          count(*) FILTER ({c} NOT BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1)) AS outliers
        FROM {source}, (SELECT quantile_cont({c}::double, 0.25) AS q1, quantile_cont({c}::double, 0.5) AS median,
          quantile_cont({c}::double, 0.75) AS q3 FROM {source}) GROUP BY q1, median, q3"""
        for c in columns
    )


@query("ag15_box_statistics", with_ctes(sql_box("gold", FEATURE_NAMES), "gold"))
def ag15(spark, sf):
    return rounded(distribution.box_statistics(gold_table(spark, sf), FEATURE_NAMES))


_CORR = _long_sql(
    f"SELECT '{x}' AS x, '{y}' AS y, {r(f'corr({x}::double, {y}::double)', 6)} AS r FROM gold"
    for x in FEATURE_NAMES
    for y in FEATURE_NAMES
)


@query("ag16_correlations", with_ctes(_CORR, "gold"))
def ag16(spark, sf):
    return rounded(distribution.correlations(gold_table(spark, sf), FEATURE_NAMES))


_PROFILED = ["speed_mps", "accel_mps2", "gyro", "heading", "odometer_km", "posted_speed_limit"]


def sql_profile(source: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        inside = f"{c} BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1)"
        # third standardised moment with population deviation
        skew = f"(avg(power({c} - m, 3)) / power(stddev_pop({c}), 3))"
        return f"""SELECT '{c}' AS "column", {r(f'100.0::double * count(*) FILTER ({c} IS NULL) / count(*)')} AS missing_pct,
          {r(f'avg({c})')} AS mean, {r(f'var_samp({c})')} AS variance, {r(skew)} AS skewness,
          count(DISTINCT {c}) AS cardinality, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
          count(*) FILTER (NOT ({inside})) AS outliers, count(DISTINCT {c}) <= 1 AS is_constant,
          coalesce(abs({skew}) > 1, false) AS is_skewed, count(*) FILTER (NOT ({inside})) > 0 AS has_outliers
        FROM {source}, (SELECT avg({c}) AS m, quantile_cont({c}::double, 0.25) AS q1,
          quantile_cont({c}::double, 0.5) AS median, quantile_cont({c}::double, 0.75) AS q3 FROM {source})
        GROUP BY q1, median, q3, m"""

    return _long_sql(one(c) for c in columns)


@query("ag29_profile", with_ctes(sql_profile("telemetry", _PROFILED), "telemetry"))
def ag29(spark, sf):
    events = store(inputs.telemetry(spark, sf).select(*_PROFILED), "telemetry")
    return rounded(distribution.profile(events, _PROFILED))


def _sql_merged_profile(c: str) -> str:
    skew = f"(avg(power({c} - m, 3)) / power(stddev_pop({c}), 3))"
    return f"""SELECT '{c}' AS "column", count(*) AS rows, {r(f'100.0::double * count(*) FILTER ({c} IS NULL) / count(*)')} AS missing_pct,
      {r(f'avg({c})')} AS mean, {r(f'var_samp({c})')} AS variance, {r(skew)} AS skewness, {r(f'min({c})::double')} AS min,
      {r(f'max({c})::double')} AS max, min({c}) IS NOT DISTINCT FROM max({c}) AS is_constant,
      coalesce(abs({skew}) > 1, false) AS is_skewed, count(DISTINCT {c}) AS exact_cardinality, true AS cardinality_near,
      true AS quartiles_near
    FROM telemetry, (SELECT avg({c}) AS m FROM telemetry) GROUP BY m"""


@query("ag29_mergeable_profile", with_ctes(_long_sql(_sql_merged_profile(c) for c in _PROFILED), "telemetry"))
def ag29_merged(spark, sf):
    """The profile read off the parts of three loads; estimates are held against the rows: ranks of the quartiles within
    1 %, cardinality within 5 %."""
    events = store(inputs.telemetry(spark, sf).select("event_seq_no", *_PROFILED), "telemetry")
    path = scratch_path(spark, "profile-parts")
    for k in range(3):
        profiles.add_load(events.where(F.col("event_seq_no") % 3 == k), _PROFILED, path, f"load{k}")
    found = profiles.current(spark, path)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in _PROFILED]))
    counted = (
        events.select(cells.alias("s")).select("s.*").where("x IS NOT NULL").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    )
    # one row for each profiled column
    values = counted.join(F.broadcast(found.select("column", "q1", "median", "q3")), "column")
    total = F.sum("n")
    near = F.lit(True)
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        below = F.sum(F.when(F.col("x") < F.col(name), F.col("n")).otherwise(0)) / total
        upto = F.sum(F.when(F.col("x") <= F.col(name), F.col("n")).otherwise(0)) / total
        near = near & (below <= q + 0.01) & (upto >= q - 0.01)
    held = values.groupBy("column").agg(F.count(F.lit(1)).alias("exact_cardinality"), near.alias("quartiles_near"))
    off = F.abs(F.col("cardinality") - F.col("exact_cardinality"))
    return rounded(
        found.join(held, "column", "left").select(
            "column", "rows", "missing_pct", "mean", "variance", "skewness", "min", "max", "is_constant", "is_skewed",
            F.coalesce("exact_cardinality", F.lit(0)).alias("exact_cardinality"),
            F.coalesce(off <= F.greatest(F.lit(1.0), 0.05 * F.col("exact_cardinality")), F.col("cardinality") == 0).alias("cardinality_near"),
            F.coalesce("quartiles_near", F.col("q1").isNull()).alias("quartiles_near"),
        )
    )


_TOP = ["driver_id", "source", "weather", "vehicle_type"]


@query(
    "ag29_top_values",
    with_ctes(
        'SELECT "column", value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value)'
        " AS rank FROM ("
        + _long_sql(
            f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM telemetry WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in _TOP
        )
        + ")) WHERE rank <= 10",
        "telemetry",
    ),
)
def ag29_top(spark, sf):
    return distribution.top_values(inputs.telemetry(spark, sf), _TOP)


_REPORTED = ["trip_count", "avg_speed_mps", "harsh_brake_rate", "harsh_accel_rate", "overspeed_rate",
             "night_trip_ratio", "total_km"]


@query(
    "ag30_training_report",
    with_ctes(
        "SELECT section, item, value FROM ("
        + _long_sql(
            [
                "SELECT 'label share' AS section, claim_occurred::varchar AS item,"
                f" {r('count(*) / (SELECT count(*) FROM training)', 3)} AS value FROM training GROUP BY claim_occurred",
                "SELECT 'rows', 'rows', count(*)::double FROM training",
            ]
            + [
                f"SELECT 'claims', '{name}', {r(expression, 2)} FROM training WHERE claim_occurred"
                for name, expression in {
                    "count": "count(*)::double",
                    "mean": "avg(claim_amount)",
                    "std": "stddev_samp(claim_amount)",
                    "min": "min(claim_amount)",
                    "q25": "quantile_cont(claim_amount, 0.25)",
                    "q50": "quantile_cont(claim_amount, 0.5)",
                    "q75": "quantile_cont(claim_amount, 0.75)",
                    "max": "max(claim_amount)",
                }.items()
            ]
            + [f"SELECT 'feature mean', '{c}', {r(f'avg({c})', 3)} FROM training" for c in _REPORTED]
        )
        + ")",
        "training",
    ),
)
def ag30(spark, sf):
    from milemark.plans.quality import training_report

    return training_report(training_table(spark, sf))


@query(
    "jn1_attached_counts",
    with_ctes(
        """SELECT driver_id, trip_id, coalesce(harsh, 0) AS harsh_brakes FROM trips LEFT JOIN (
             SELECT driver_id, trip_id, count(*) AS harsh FROM silver WHERE accel_mps2 < -3 GROUP BY ALL)
           USING (driver_id, trip_id)""",
        "trips",
    ),
)
def jn1(spark, sf):
    events = silver_table(spark, sf)
    kept = events.filter(F.col("accel_mps2") < -3).groupBy(*trips.TRIP_KEYS).agg(
        F.count(F.lit(1)).alias("harsh_brakes")
    )
    return trips.attach_trip_counts(events.select(*trips.TRIP_KEYS).distinct(), kept, ["harsh_brakes"])


@query(
    "jn2_features_with_km",
    with_ctes(
        f"""SELECT driver_id, total_events, {r('total_km')} AS total_km FROM driver_events LEFT JOIN (
              SELECT * FROM km WHERE total_km > 300) USING (driver_id)""",
        "driver_events", "km",
    ),
)
def jn2(spark, sf):
    events = silver_table(spark, sf)
    km = features.total_km_from_trips(trips.trip_summary(events)).filter("total_km > 300")
    joined = features.add_total_km(features.driver_event_features(events), km)
    return rounded(joined.select("driver_id", "total_events", "total_km"))


@query(
    "jn3_device_lookup",
    with_ctes(
        """SELECT event_id, ingestion_ts, device_keys.driver_id IS NOT NULL AS known FROM telemetry
           LEFT JOIN device_keys USING (driver_id)""",
        "telemetry", "device_keys",
    ),
)
def jn3(spark, sf):
    keys = inputs.device_keys(spark, sf)
    return inputs.telemetry(spark, sf).join(keys, "driver_id", "left").select(
        "event_id", "ingestion_ts", F.col("secret").isNotNull().alias("known")
    )
