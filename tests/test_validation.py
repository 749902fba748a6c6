import pytest
from pyspark.sql import functions as F

from milemark.operators import cleaning, validation
from milemark.schemas import DRIVER_FEATURES, EVENTS, SILVER_EVENTS, conform

FAILING = {
    "SCHEMA_VALIDATION_FAILED": {"trip_id": None},
    "MISSING_LAT_LON": {"lon": None},
    "LAT_LON_OUT_OF_RANGE": {"lat": 90.5},
    "NEGATIVE_SPEED": {"speed_mps": -0.1},
    "ACCEL_OUT_OF_RANGE": {"accel_mps2": -10.5},
    "HEADING_OUT_OF_RANGE": {"heading": 360.0},
    "INVALID_DRIVER_AGE_BAND": {"driver_age_band": "under25"},
    "INVALID_VEHICLE_TYPE": {"vehicle_type": "BUS"},
    "INVALID_OWNERSHIP_TYPE": {"ownership_type": "RENTED"},
    "INVALID_WEATHER": {"weather": "OTHER"},
    "INVALID_ROAD_TYPE": {"road_type": "alley"},
    "INVALID_SAFETY_RATING": {"safety_rating": 5.5},
    "INVALID_MODEL_YEAR": {"vehicle_model_year": 2026},
    "INVALID_CRIME_INDEX": {"crime_index": -0.5},
    "INVALID_ACCIDENT_INDEX": {"accident_index": -1.0},
}


def reasons(events):
    return {r["event_id"]: r["reason"] for r in validation.validate(events).collect()}


def test_every_reason(make_events):
    assert list(FAILING) == validation.REASONS
    found = reasons(make_events(*FAILING.values()))
    assert [found[f"e{i}"] for i in range(len(FAILING))] == list(FAILING)


def test_valid_events_and_borders(make_events):
    valid = [
        {}, {"accel_mps2": None, "heading": None}, {"accel_mps2": 10.0}, {"accel_mps2": -10.0}, {"heading": 0.0},
        {"lat": -90.0, "lon": 180.0}, {"speed_mps": 0.0}, {"safety_rating": 0.0}, {"vehicle_model_year": 1980},
        {"crime_index": 0.0}, {"weather": None, "vehicle_type": None}, {"driver_age_band": ""},
        {"safety_rating": None, "vehicle_model_year": None, "crime_index": None, "accident_index": None},
    ]
    assert set(reasons(make_events(*valid)).values()) == {"OK"}


def test_first_reason_wins(make_events):
    found = reasons(make_events({"speed_mps": -1.0, "weather": "hail"}, {"lat": None, "event_seq_no": None}, {"speed_mps": None}))
    assert found == {"e0": "NEGATIVE_SPEED", "e1": "SCHEMA_VALIDATION_FAILED", "e2": "NEGATIVE_SPEED"}


def test_unknown_source_breaks_the_schema(make_events):
    assert reasons(make_events({"source": "radio"}, {"source": None})) == {
        "e0": "SCHEMA_VALIDATION_FAILED", "e1": "SCHEMA_VALIDATION_FAILED",
    }


def test_routing_loses_nothing(make_events):
    good, bad = validation.route(validation.validate(make_events({}, *FAILING.values())))
    assert good.count() == 1 and "reason" not in good.columns
    assert {r["_dlq_reason"] for r in bad.collect()} == set(FAILING)


def test_sanity_filter_borders(make_events):
    events = make_events(
        {"accel_mps2": 12.0}, {"accel_mps2": -12.1}, {"accel_mps2": None}, {"speed_mps": 80.0}, {"speed_mps": 80.1},
        {"speed_mps": 0.0}, {"lat": 91.0}, {"lon": None},
    )
    assert {r["event_id"] for r in cleaning.sanity_filter(events).collect()} == {"e0", "e3", "e5"}


def test_nan_counts_as_missing(make_events):
    events = conform(make_events({"speed_mps": float("nan")}, {"accel_mps2": float("nan")}, {}), EVENTS)
    assert {r["event_id"] for r in cleaning.sanity_filter(events).collect()} == {"e2"}
    assert reasons(events)["e0"] == "NEGATIVE_SPEED"


def test_enum_modes(make_events):
    events = make_events({"weather": "hail"}, {"weather": None}, {"weather": "rain"}, {"road_type": "alley"})
    assert {r["event_id"] for r in cleaning.drop_bad_enums(events).collect()} == {"e1", "e2"}
    remapped = {r["event_id"]: (r["weather"], r["road_type"]) for r in cleaning.remap_bad_enums(events).collect()}
    assert remapped["e0"] == ("OTHER", "urban") and remapped["e3"] == ("clear", "OTHER")
    assert remapped["e1"][0] is None
    assert cleaning.drop_bad_enums(events.drop("weather")).count() == 3


def test_heading_filter_keeps_missing(make_events):
    events = make_events({"heading": None}, {"heading": 359.9}, {"heading": 360.0}, {"heading": -0.1})
    assert {r["event_id"] for r in cleaning.heading_filter(events).collect()} == {"e0", "e1"}


def test_conform_adds_drops_orders_and_casts(spark):
    df = spark.createDataFrame([("d", 3, 1.5, "x")], "driver_id string, trip_count bigint, total_km double, extra string")
    out = conform(df, DRIVER_FEATURES)
    assert out.columns == [f.name for f in DRIVER_FEATURES.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in DRIVER_FEATURES.fields]
    row = out.first()
    assert row["trip_count"] == 3 and row["speed_std"] is None and row["total_km"] == 1.5


def test_silver_trip_columns_start_null(make_events):
    out = conform(make_events({}).withColumn("event_date", F.lit("2023-11-14")), SILVER_EVENTS).first()
    assert out["session_id"] is None and out["harsh_brake_events"] is None and out["event_date"] == "2023-11-14"


def test_labels_are_renamed_and_required(spark):
    df = spark.createDataFrame([("d", True, 5.0)], "driver_id string, claim_occurred boolean, claim_amount double")
    assert cleaning.unify_label_names(df).columns == ["driver_id", "had_claim_within_30d", "claim_severity"]
    with pytest.raises(ValueError, match="claim_severity"):
        cleaning.unify_label_names(df.drop("claim_amount"))
    both = df.withColumn("had_claim_within_30d", F.lit(False))
    assert cleaning.label_columns(both.columns) == ("had_claim_within_30d", "claim_amount")
    assert cleaning.label_columns(["x"]) == (None, None)
    # neither booleans, ids nor labels are features
    assert cleaning.numeric_features(both.withColumn("total_km", F.lit(1.0))) == ["total_km"]


def test_contract_report_names_differences(make_events):
    events = make_events({}).drop("gyro").withColumn("lat", F.col("lat").cast("float"))
    report = {r["column"]: r for r in validation.contract_report(events).collect()}
    assert not report["gyro"]["present"] and not report["lat"]["type_ok"] and report["lon"]["type_ok"]
    assert report["source"]["domain"] == "phone,OBD,simulator" and report["event_id"]["kind"] == "required"


def test_training_consistency(spark):
    data = spark.createDataFrame([("a", True), ("b", False)], "driver_id string, claim_occurred boolean")
    fits = spark.createDataFrame([(2, 1)], "rows bigint, positives bigint")
    silent = spark.createDataFrame([(3, None)], "rows bigint, positives bigint")
    row = validation.training_consistency(data, fits).first()
    assert row["rows_ok"] and row["positives_ok"]
    row = validation.training_consistency(data, silent).first()
    assert not row["rows_ok"] and row["positives_ok"]


def test_dedup_is_idempotent_and_ordered(make_events):
    events = make_events(
        {"event_id": "x", "ingestion_ts": 5, "accel_mps2": 1.0}, {"event_id": "x", "ingestion_ts": 5, "accel_mps2": None},
        {"event_id": "x", "ingestion_ts": 4}, {"event_id": "y"},
    )
    once = cleaning.dedup_events(events)
    assert {(r["event_id"], r["ingestion_ts"]) for r in once.collect()} == {("x", 4), ("y", 1_700_000_000_500)}
    assert cleaning.dedup_events(once).count() == 2
    tie = cleaning.dedup_events(events.filter("ingestion_ts = 5")).first()
    assert tie["accel_mps2"] is None  # nulls first
