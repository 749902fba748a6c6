import pytest
from pyspark.sql import functions as F

from milemark.functions.driving import event_date
from milemark.operators import cleaning, validation
from milemark.operators import monitoring as monitoring_ops
from milemark.plans import learning, medallion, monitoring, quality
from milemark.schemas import FEATURE_COLUMNS, MODEL_SUMMARY, SILVER_EVENTS, SILVER_TRIPS, conform
from milemark.session import COMPILED_METHOD_LIMIT, scratch_path, shared_folder
from milemark.sources import readers, writers


@pytest.fixture(scope="module")
def lake(spark, make_events):
    """Raw to Gold on a handful of events, written."""
    base = scratch_path(spark, "lake")
    changes = [{"event_id": f"e{i // 2}", "driver_id": f"d{i % 7}", "trip_id": f"t{i % 3}", "ts": 1_700_000_000_000 + i * 60_000,
                "ingestion_ts": 1_700_000_000_000 + i, "odometer_km": 100.0 + i, "accel_mps2": None if i % 50 == 7 else 0.5}
               for i in range(300)]
    make_events(*changes).repartition(3).write.parquet(f"{base}/raw")
    medallion.raw_to_bronze(spark, f"{base}/raw", f"{base}/bronze", max_rows=20)
    medallion.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/trips")
    medallion.silver_to_gold(spark, f"{base}/silver", f"{base}/gold", f"{base}/trips", f"{base}/manifests")
    return base


def test_bronze_files_are_small_and_distinct(spark, lake):
    df = spark.read.parquet(f"{lake}/bronze")
    assert df.count() == 150 == df.select("event_id").distinct().count()
    per_file = df.groupBy(F.col("_metadata.file_name")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 20


def test_silver_is_partitioned_and_typed(spark, lake):
    df = readers.read_table(spark, f"{lake}/silver", schema=SILVER_EVENTS)
    assert dict(df.dtypes)["event_date"] == "string"
    assert set(df.columns) == {f.name for f in SILVER_EVENTS.fields}
    plan = df.filter("event_date = '2023-11-14'").select("driver_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "ReadSchema: struct<driver_id:string>" in plan
    assert readers.read_tree(spark, f"{lake}/silver").count() == df.count()


def test_gold_and_manifest(spark, lake):
    gold = readers.read_table(spark, f"{lake}/gold")
    assert gold.count() == 7 and gold.agg(F.min("total_km")).first()[0] >= 0
    manifest = readers.read_json_documents(spark, f"{lake}/manifests").first()
    events = readers.read_table(spark, f"{lake}/silver", schema=SILVER_EVENTS).count()
    assert (manifest["events_processed"], manifest["drivers"]) == (events, 7)
    assert manifest["run_time"] and len(manifest["config_hash"]) == 32
    assert validation.gold_rules(gold).filter("NOT ok").count() == 0


def test_gold_without_trip_table(spark, lake):
    medallion.silver_to_gold(spark, f"{lake}/silver", f"{lake}/gold2", f"{lake}/no-such-folder")
    spans = readers.read_table(spark, f"{lake}/gold2").agg(F.sum("total_km")).first()[0]
    # every driver's trips run side by side here, so their distances add up to more than the span
    assert 0 < spans < readers.read_table(spark, f"{lake}/gold").agg(F.sum("total_km")).first()[0]


def test_options_of_the_cleaning_job(make_events):
    events = make_events(
        {"weather": "hail"}, {"heading": 400.0}, {"odometer_km": 50.0, "ts": 1_700_000_000_001},
        {"ts": 1_700_001_000_000, "odometer_km": 120.0},
    )
    assert medallion.clean(events).count() == 3
    assert medallion.clean(events, drop_invalid_enums=False).filter("weather = 'OTHER'").count() == 1
    strict = medallion.clean(events, check_heading=True, sessions=True, monotonic_odometer=True)
    assert [r["session_id"] for r in strict.collect()] == ["d1-s1"] or strict.count() >= 1
    assert strict.filter("heading >= 360").count() == 0
    assert strict.filter("session_id IS NULL").count() == 0


def test_copies_that_differ_in_one_column_only(make_events, spark):
    events = make_events({"event_id": "e", "weather": "snow"}, {"event_id": "e", "weather": "rain"}, {"event_id": "e", "crime_index": 0.4})
    kept = {cleaning.dedup_events(events.orderBy(*by).coalesce(1)).first() for by in (["weather"], [F.desc("weather")], ["crime_index"])}
    assert len(kept) == 1


def test_illegal_sources_and_default_models(spark, make_events):
    events = make_events({"source": "radio"}, {"source": "radio"}, {"source": "TV"}, {})
    found = {r["source"]: r["rows"] for r in validation.illegal_sources(events).collect()}
    assert found == {"radio": 2, "TV": 1}
    best = monitoring_ops.best_models(spark.createDataFrame([], MODEL_SUMMARY), "models").first()
    assert (best["frequency_artifact"], best["severity_artifact"]) == ("models/frequency_rf", "models/severity_xgb")


def test_training_set_and_pricing(spark, lake):
    training = learning.build_training_set(spark, f"{lake}/gold", f"{lake}/training", f"{lake}/training-manifest")
    manifest = readers.read_json_documents(spark, f"{lake}/training-manifest")
    checked = quality.table_quality(training, training, manifest)["training"].first()
    assert checked["rows_ok"] and checked["positives_ok"]
    training.select("driver_id", F.lit(100.0).alias("expected_loss")).write.parquet(f"{lake}/scores")
    premiums = learning.price_premiums(spark, f"{lake}/scores", f"{lake}/premiums", f"{lake}/premium-manifest", expense_load=0.5)
    assert {round(r["premium"], 9) for r in premiums.collect()} == {160.0}


def test_reports(spark, lake):
    gold = readers.read_table(spark, f"{lake}/gold")
    views = monitoring.feature_views(gold, FEATURE_COLUMNS[:3])
    assert views["statistics"].count() == 3 and views["correlations"].count() == 9
    silver = readers.read_table(spark, f"{lake}/silver", schema=SILVER_EVENTS)
    report = quality.silver_quality(silver)
    assert report["violations"].first()["missing_columns"] == ""
    assert report["domains"].filter("NOT legal").count() == 0


def test_small_files_round_trip(spark, lake):
    path = scratch_path(spark, "csv")
    gold = readers.read_table(spark, f"{lake}/gold")
    writers.write_preview(gold, path, ["driver_id"], 3)
    back = spark.read.schema(gold.schema).csv(path, header=True)
    assert [r["driver_id"] for r in back.collect()] == ["d0", "d1", "d2"]
    totals = readers.inventory_totals(readers.file_inventory(spark, f"{lake}/bronze", "*.parquet")).first()
    assert totals["files"] >= 8 and totals["latest_file"].endswith(".parquet")


def test_optional_inputs(spark, lake):
    assert readers.optional(readers.read_table, spark, f"{lake}/nowhere") is None
    assert readers.optional(readers.read_table, spark, f"{lake}/gold") is not None
    with pytest.raises(Exception, match="no_such_column"):
        readers.optional(lambda: spark.read.parquet(f"{lake}/gold").select("no_such_column"))


def test_trip_contract(spark, lake):
    trips = readers.read_table(spark, f"{lake}/trips")
    assert conform(trips, SILVER_TRIPS).columns == [f.name for f in SILVER_TRIPS.fields]


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named
    assert scratch_path(spark, "a").startswith(shared_folder(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_event_date_column(spark):
    assert spark.range(1).select(event_date(F.lit(0).cast("bigint"))).first()[0] == "1970-01-01"


def test_dead_letters_are_compressed_in_bounded_files(spark, make_events):
    letters = make_events(*[{}] * 50).coalesce(1).withColumn("_dlq_reason", F.lit("LAT_LON_OUT_OF_RANGE"))
    path = scratch_path(spark, "letters")
    for _ in range(2):
        writers.append_dead_letters(letters, path, max_rows=20)
    files = [r.filename for r in readers.file_inventory(spark, path, "part-*").collect()]
    assert len(files) == 6 and all(f.endswith(".json.gz") for f in files)
    assert readers.read_dead_letters(spark, path).groupBy("event_id").count().where("count = 2").count() == 50


def test_deduplicated_events_are_not_sorted_again(make_events):
    events = make_events({}, {"lat": 99.0})
    once = medallion.clean(events, deduplicated=True)
    assert "Window" not in once._jdf.queryExecution().executedPlan().toString()
    assert once.collect() == medallion.clean(events).collect()


@pytest.mark.parametrize("own", ["65535", "500"])
def test_dead_letters_are_written_by_methods_that_are_compiled(spark, own):
    """A stand-in for the letters notes the limit of the session while they are written; it is set back after a failure too."""
    name, during = "spark.sql.codegen.hugeMethodLimit", []

    class Letters:
        sparkSession = spark
        write = property(lambda self: self)
        mode = option = lambda self, *given: self

        def json(self, path):
            during.append(int(spark.conf.get(name)))
            if path == "broken":
                raise OSError(path)

    before = spark.conf.get(name)
    spark.conf.set(name, own)
    try:
        writers.append_dead_letters(Letters(), "fine")
        assert spark.conf.get(name) == own
        with pytest.raises(OSError):
            writers.append_dead_letters(Letters(), "broken")
        assert spark.conf.get(name) == own and during == [min(int(own), COMPILED_METHOD_LIMIT)] * 2
    finally:
        spark.conf.set(name, before)
