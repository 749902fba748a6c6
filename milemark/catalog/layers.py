"""Queries for sources, sinks and the jobs between the layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.aggregates import rounded_trips, sql_trip_columns
from milemark.catalog.cleaning import REASON_SQL, spoiled_gold
from milemark.catalog.registry import (
    CTES, FEATURE_NAMES, ORACLES, bronze, gold, gold_table, query, r, rounded, silver, silver_trips, sql_features, training,
    with_ctes,
)
from milemark.functions.driving import event_date
from milemark.operators import cleaning, features, labels, trips, validation
from milemark.plans import incremental, learning, medallion, monitoring, quality
from milemark.schemas import EVENTS, SILVER_EVENTS, conform
from milemark.session import scratch_path
from milemark.sources import readers, writers


def _raw_files(spark, sf) -> str:
    path = scratch_path(spark, "raw")
    conform(inputs.telemetry(spark, sf), EVENTS).write.parquet(path)
    return path


def _silver_files(spark, sf) -> str:
    path = scratch_path(spark, "silver")
    events = silver(spark, sf).withColumn("event_date", event_date(F.col("ts")))
    writers.write_silver_events(conform(events, SILVER_EVENTS), path)
    return path


_BY_SOURCE = """SELECT source, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
  sum(speed_mps) AS speed_sum, count(accel_mps2) AS accels FROM {t} GROUP BY source"""


def _by_source(df):
    return df.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum("speed_mps").alias("speed_sum"), F.count("accel_mps2").alias("accels"),
    )


@query("src1_raw_scan", with_ctes(_BY_SOURCE.format(t="telemetry"), "telemetry"))
def src1(spark, sf):
    return _by_source(readers.read_raw_events(spark, _raw_files(spark, sf)))


@query(
    "src2_bronze_scan",
    with_ctes(
        """SELECT source, sum(n)::bigint AS n FROM (SELECT source, count(*) AS n FROM telemetry GROUP BY source
           UNION ALL SELECT source, count(*) FROM bronze GROUP BY source) GROUP BY source""",
        "bronze",
    ),
)
def src2(spark, sf):
    """Two folders of files as one table."""
    first, second = _raw_files(spark, sf), scratch_path(spark, "bronze")
    writers.write_bronze(conform(bronze(spark, sf), EVENTS), second)
    return readers.read_table(spark, first, second).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


_BY_DATE = """SELECT strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS event_date, count(*) AS n,
  count(DISTINCT driver_id) AS drivers, sum(odometer_km) AS km FROM silver GROUP BY event_date"""


def _by_date(df):
    return df.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("driver_id").alias("drivers"), F.sum("odometer_km").alias("km")
    )


@query("src3_partitioned_scan", with_ctes(_BY_DATE, "silver"))
def src3(spark, sf):
    return _by_date(readers.read_table(spark, _silver_files(spark, sf), schema=SILVER_EVENTS))


@query("src3_pruned_scan", with_ctes(f"SELECT * FROM ({_BY_DATE}) WHERE event_date >= '1996-01-01'", "silver"))
def src3_pruned(spark, sf):
    """A range of days reads only their folders."""
    events = readers.read_table(spark, _silver_files(spark, sf), schema=SILVER_EVENTS)
    return _by_date(events.filter(F.col("event_date") >= "1996-01-01"))


@query("src4_tree_scan", with_ctes(_BY_SOURCE.format(t="silver"), "silver"))
def src4(spark, sf):
    return _by_source(readers.read_tree(spark, _silver_files(spark, sf), "*.parquet"))


@query(
    "src4_by_folder", with_ctes(f"SELECT * FROM ({_BY_DATE}) WHERE event_date LIKE '1996-%'", "silver")
)
def src4_folder(spark, sf):
    """Only the folders of one year; the day comes back from their names."""
    events = readers.read_tree(spark, _silver_files(spark, sf), folder_glob="event_date=1996-*")
    return _by_date(events.withColumn("event_date", F.col("event_date").cast("string")))


def _dead_letter_files(spark, sf) -> str:
    path = scratch_path(spark, "dlq")
    _, bad = validation.route(validation.validate(inputs.telemetry(spark, sf)))
    columns = [c.name for c in EVENTS.fields if c.name in bad.columns]
    writers.append_dead_letters(bad.select(*columns, "_dlq_reason"), path)
    return path


@query(
    "src6_dead_letters",
    with_ctes(
        f"""SELECT event_id, reason AS _dlq_reason FROM (SELECT event_id, ingestion_ts, {REASON_SQL} AS reason
            FROM telemetry) WHERE reason <> 'OK' ORDER BY event_id, ingestion_ts, reason LIMIT 10""",
        "telemetry",
    ),
)
def src6(spark, sf):
    letters = readers.read_dead_letters(spark, _dead_letter_files(spark, sf))
    ordered = cleaning.first_rows(letters, ["event_id", "ingestion_ts", "_dlq_reason"], 10)
    return ordered.select("event_id", "_dlq_reason")


@query(
    "src6_dead_letter_lines",
    with_ctes(f"SELECT count(*) AS lines FROM (SELECT {REASON_SQL} AS reason FROM telemetry) WHERE reason <> 'OK'", "telemetry"),
)
def src6_lines(spark, sf):
    return readers.count_lines(spark, _dead_letter_files(spark, sf))


@query(
    "src9_optional_trips",
    with_ctes(
        """SELECT driver_id, total_events::int AS total_events, total_km FROM driver_events
           JOIN (SELECT driver_id, max(odometer_km) - min(odometer_km) AS total_km FROM silver GROUP BY driver_id)
           USING (driver_id)""",
        "driver_events",
    ),
)
def src9(spark, sf):
    """Without a trip table the distance comes from the odometer."""
    missing = readers.optional(readers.read_table, spark, scratch_path(spark, "no-trips"))
    table = features.driver_features(silver(spark, sf), missing)
    return table.select("driver_id", "total_events", "total_km")


@query("src10_file_inventory", with_ctes("SELECT count(*) AS rows, true AS all_listed, true AS sized, true AS dated FROM bronze", "bronze"))
def src10(spark, sf):
    """The inventory lists the files that the rows come from, with sizes; the latest is one of them."""
    path = scratch_path(spark, "bronze")
    writers.write_bronze(conform(bronze(spark, sf), EVENTS), path)
    totals = readers.inventory_totals(readers.file_inventory(spark, path, "*.parquet"))
    per_file = spark.read.schema(EVENTS).parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    files = totals.select("files").scalar()
    return per_file.agg(
        F.sum("n").alias("rows"), (F.count(F.lit(1)) == files).alias("all_listed"),
        (totals.select("total_kb").scalar() > 0).alias("sized"),
        F.max(F.col("file") == totals.select("latest_file").scalar()).alias("dated"),
    )


@query("snk1_bronze_files", with_ctes("SELECT count(*) AS rows, true AS within_limit, count(*) > 5000 AS several FROM bronze", "bronze"))
def snk1(spark, sf):
    """Rows of all written files: none above the limit."""
    path = scratch_path(spark, "bronze")
    writers.write_bronze(conform(bronze(spark, sf), EVENTS), path, max_rows=5_000)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("rows"), (F.max("n") <= 5_000).alias("within_limit"), (F.count(F.lit(1)) > 1).alias("several")
    )


@query("snk2_silver_events", with_ctes(_BY_DATE, "silver"))
def snk2(spark, sf):
    base = scratch_path(spark, "snk2")
    medallion.raw_to_bronze(spark, _raw_files(spark, sf), f"{base}/bronze")
    medallion.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver")
    return _by_date(readers.read_table(spark, f"{base}/silver", schema=SILVER_EVENTS))


@query("snk3_trips", with_ctes(f"SELECT {sql_trip_columns()} FROM trips", "trips"))
def snk3(spark, sf):
    path = scratch_path(spark, "trips")
    writers.write_trips(silver_trips(spark, sf), path)
    return rounded_trips(readers.read_table(spark, path))


@query("snk4_gold", with_ctes(f"SELECT {sql_features()} FROM gold", "gold"))
def snk4(spark, sf):
    path = scratch_path(spark, "gold")
    writers.write_gold(gold(spark, sf), path)
    return rounded(readers.read_table(spark, path))


@query(
    "snk5_dead_letters_appended",
    with_ctes(
        f"""SELECT reason AS _dlq_reason, 2 * count(*) AS n FROM (SELECT {REASON_SQL} AS reason FROM telemetry)
            WHERE reason <> 'OK' GROUP BY reason""",
        "telemetry",
    ),
)
def snk5(spark, sf):
    """Appending twice keeps both."""
    path = _dead_letter_files(spark, sf)
    _, bad = validation.route(validation.validate(inputs.telemetry(spark, sf)))
    writers.append_dead_letters(bad, path)
    return readers.read_dead_letters(spark, path).groupBy("_dlq_reason").agg(F.count(F.lit(1)).alias("n"))


@query("snk7_csv_preview", with_ctes(f"SELECT {sql_features()} FROM gold ORDER BY driver_id LIMIT 20", "gold"))
def snk7(spark, sf):
    path = scratch_path(spark, "preview")
    table = gold(spark, sf)
    writers.write_preview(rounded(table), path, ["driver_id"])
    return spark.read.schema(table.schema).csv(path, header=True)


@query(
    "snk8_manifest",
    with_ctes(
        f"""SELECT count(*) AS drivers, sum(total_events)::bigint AS events, {r('avg(total_km)')} AS mean_km,
            'raw' AS limit_unit FROM gold""",
        "gold",
    ),
)
def snk8(spark, sf):
    path = scratch_path(spark, "manifests")
    row = writers.manifest(
        gold(spark, sf),
        {"drivers": F.count(F.lit(1)), "events": F.sum("total_events"), "mean_km": F.round(F.avg("total_km"), 6)},
        {"limit_unit": "raw"},
    )
    writers.append_manifest(row, path)
    return readers.read_json_documents(spark, path).select("drivers", "events", "mean_km", "limit_unit")


@query("jb2_raw_to_bronze", with_ctes(_BY_SOURCE.format(t="bronze"), "bronze"))
def jb2(spark, sf):
    base = scratch_path(spark, "jb2")
    medallion.raw_to_bronze(spark, _raw_files(spark, sf), base)
    return _by_source(readers.read_raw_events(spark, base))


@query("jb3_bronze_to_silver", with_ctes(f"SELECT {sql_trip_columns()} FROM trips", "trips"))
def jb3(spark, sf):
    base = scratch_path(spark, "jb3")
    medallion.bronze_to_silver(spark, _raw_files(spark, sf), f"{base}/events", f"{base}/trips")
    return rounded_trips(readers.read_table(spark, f"{base}/trips"))


CTES["steady"] = (
    ["silver"],
    """SELECT * EXCLUDE (reached) FROM (SELECT *, max(odometer_km) OVER (PARTITION BY driver_id, trip_id
         ORDER BY ts, event_seq_no, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
         FROM silver WHERE heading IS NULL OR (heading >= 0 AND heading < 360))
       WHERE NOT coalesce(odometer_km < reached, false)""",
)


@query(
    "jb3_all_options",
    with_ctes(
        """SELECT event_id, concat(driver_id, '-s', sum(opens) OVER (PARTITION BY driver_id
             ORDER BY ts, event_seq_no, event_id ROWS UNBOUNDED PRECEDING)::bigint::varchar) AS session_id, odometer_km
           FROM (SELECT *, CASE WHEN ts - lag(ts) OVER w <= 300000 THEN 0 ELSE 1 END AS opens
             FROM steady WINDOW w AS (PARTITION BY driver_id ORDER BY ts, event_seq_no, event_id))""",
        "steady",
    ),
)
def jb3_options(spark, sf):
    """Heading, odometer and session checks of the cleaning job switched on."""
    base = scratch_path(spark, "jb3o")
    medallion.bronze_to_silver(
        spark, _raw_files(spark, sf), f"{base}/events", check_heading=True, sessions=True, monotonic_odometer=True
    )
    events = readers.read_table(spark, f"{base}/events", schema=SILVER_EVENTS)
    return events.select("event_id", "session_id", "odometer_km")


@query("jb4_silver_to_gold", with_ctes(f"SELECT {sql_features()} FROM gold", "gold"))
def jb4(spark, sf):
    base = scratch_path(spark, "jb4")
    medallion.bronze_to_silver(spark, _raw_files(spark, sf), f"{base}/events", f"{base}/trips")
    return rounded(
        medallion.silver_to_gold(spark, f"{base}/events", f"{base}/gold", f"{base}/trips", f"{base}/manifests")
    )


def _loads(spark, sf, n: int = 3) -> str:
    """The raw events in ``n`` loads by order of arrival; copies of an event may come in different ones."""
    base = scratch_path(spark, "loads")
    events = readers.read_raw_events(spark, _raw_files(spark, sf))
    first, last = events.agg(F.min("ingestion_ts"), F.max("ingestion_ts")).first()
    span = F.floor((F.col("ingestion_ts") - first) * n / (last - first + 1))
    for k in range(n):
        events.where(span == k).write.parquet(f"{base}/raw/load={k}")
        incremental.take_load(spark, f"{base}/raw/load={k}", base, k, buckets=8, compact_every=2)
    return base


@query("sm6_incremental_gold", with_ctes(f"SELECT {sql_features()} FROM gold", "gold"))
def sm6_gold(spark, sf):
    """After three loads the driver features equal those of one batch."""
    return rounded(incremental.read_gold(spark, _loads(spark, sf), 2))


@query("sm6_incremental_trips", with_ctes(f"SELECT {sql_trip_columns()} FROM trips", "trips"))
def sm6_trips(spark, sf):
    return rounded_trips(incremental.read_trips(spark, _loads(spark, sf), 2))


@query(
    "jb5_training_set",
    with_ctes(f"SELECT {sql_features()}, claim_occurred, {r('claim_amount')} AS claim_amount FROM training", "training"),
)
def jb5(spark, sf):
    base = scratch_path(spark, "jb5")
    writers.write_gold(gold(spark, sf), f"{base}/gold")
    return rounded(learning.build_training_set(spark, f"{base}/gold", f"{base}/training", f"{base}/manifests"))


@query(
    "jb9_overview",
    with_ctes(
        f"""SELECT 'layer rows' AS section, 'silver' AS item, count(*)::double AS value FROM silver
            UNION ALL SELECT 'layer rows', 'gold', count(*)::double FROM gold
            UNION ALL SELECT 'training', 'samples', count(*)::double FROM training
            UNION ALL SELECT 'training', 'claim_rate', {r('avg(claim_occurred::int)')} FROM training
            UNION ALL SELECT 'training', 'claims', (count(*) FILTER (claim_occurred))::double FROM training
            UNION ALL SELECT 'training', 'mean_severity', {r('avg(claim_amount) FILTER (claim_occurred)')} FROM training""",
        "silver", "training",
    ),
)
def jb9(spark, sf):
    table = gold_table(spark, sf)
    return rounded(
        monitoring.overview({"silver": silver(spark, sf), "gold": table}, labels.training_set(table))
    )


@query("jb10_silver_quality", with_ctes(
    """SELECT count(*) AS row_count, count(*) FILTER (speed_mps < 0) AS bad_speed,
       count(*) FILTER (lat < -90 OR lat > 90) AS bad_lat, count(*) FILTER (lon < -180 OR lon > 180) AS bad_lon,
       count(*) FILTER (source NOT IN ('phone', 'OBD', 'simulator')) AS bad_source_rows, '' AS missing_columns
       FROM telemetry""", "telemetry"))
def jb10(spark, sf):
    """Events as they come, in the Silver contract, with all their faults."""
    events = inputs.telemetry(spark, sf).withColumn("event_date", event_date(F.col("ts")))
    return quality.silver_quality(conform(events, SILVER_EVENTS), ["violations"])["violations"]


@query("jb10_table_rules", ORACLES["val6_gold_rules"])
def jb10_rules(spark, sf):
    table, labelled = spoiled_gold(spark, sf), training(spark, sf)
    return quality.table_quality(table, labelled, labels.training_totals(labelled))["rules"]


@query("jb10_training_against_manifest", ORACLES["val5_training_consistency"])
def jb10_training(spark, sf):
    table, labelled = gold(spark, sf), training(spark, sf)
    declared = labels.training_totals(labelled).select("rows", (F.col("positives") + 1).alias("positives"))
    return quality.table_quality(table, labelled, declared)["training"]


@query("jb9_feature_statistics", ORACLES["ag12_describe"])
def jb9_statistics(spark, sf):
    return rounded(monitoring.feature_views(gold_table(spark, sf), FEATURE_NAMES)["statistics"])


@query("jb9_feature_correlations", ORACLES["ag16_correlations"])
def jb9_correlations(spark, sf):
    return rounded(monitoring.feature_views(gold_table(spark, sf), FEATURE_NAMES)["correlations"])


@query("jb9_frequency_roc", ORACLES["ag23_roc_curve"])
def jb9_roc(spark, sf):
    return rounded(monitoring.frequency_views(inputs.class_preds(spark, sf))["roc"], 9)


@query("jb9_frequency_distribution", ORACLES["ag14_histogram_by_label"])
def jb9_distribution(spark, sf):
    return monitoring.frequency_views(inputs.class_preds(spark, sf))["distribution"]


@query("jb9_severity_residuals", ORACLES["ag14_residual_histogram"])
def jb9_residuals(spark, sf):
    return monitoring.severity_views(inputs.reg_preds(spark, sf))["residuals"]


@query(
    "prj1_trip_columns_filled",
    with_ctes(
        f"""SELECT event_id, {r('t.trip_distance_km')} AS trip_distance_km, harsh_brakes::int AS harsh_brake_events
            FROM silver JOIN trips t USING (driver_id, trip_id)""",
        "silver", "trips",
    ),
)
def prj1_filled(spark, sf):
    events = conform(
        silver(spark, sf).withColumn("event_date", event_date(F.col("ts"))), SILVER_EVENTS
    )
    filled = trips.fill_trip_columns(events, trips.trip_summary(events))
    return rounded(filled.select("event_id", "trip_distance_km", "harsh_brake_events"))
