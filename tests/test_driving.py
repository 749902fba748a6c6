import math

from pyspark.sql import functions as F

from milemark.functions import driving
from milemark.operators import features, trips
from milemark.schemas import SILVER_EVENTS, conform

HOUR = 3_600_000
MONDAY = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def test_calendar_parts_and_flags(spark):
    rows = [(MONDAY + 5 * HOUR + 59 * 60_000,), (MONDAY + 6 * HOUR,), (MONDAY + 21 * HOUR,), (MONDAY + 5 * 24 * HOUR,)]
    df = spark.createDataFrame(rows, "ts bigint")
    ts = F.col("ts")
    got = df.select(
        driving.event_date(ts), driving.hour_of_day(ts), driving.weekday(ts), driving.is_night(ts), driving.is_weekend(ts)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("2024-01-01", 5, 0, True, False), ("2024-01-01", 6, 0, False, False),
        ("2024-01-01", 21, 0, True, False), ("2024-01-06", 0, 5, True, True),
    ]


def test_flags_are_inclusive_and_null_safe(spark):
    df = spark.createDataFrame([(-3.0,), (3.0,), (None,), (-2.9,)], "a double")
    a = F.col("a")
    got = df.select(driving.is_harsh_brake(a), driving.is_harsh_accel(a)).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False), (False, False)]


def test_overspeed_units(spark):
    df = spark.createDataFrame([(40.0, 50), (52.0, 50), (60.0, None), (14.0, 50), (16.0, 50)], "v double, l int")
    raw = [r[0] for r in df.select(driving.is_overspeed(F.col("v"), F.col("l"))).collect()]
    kmh = [r[0] for r in df.select(driving.is_overspeed(F.col("v"), F.col("l"), limit_unit="kmh")).collect()]
    assert raw == [False, True, False, False, False]
    assert kmh == [True, True, False, False, True]


def test_trip_summary(make_events):
    events = make_events(
        {"ts": 0, "accel_mps2": -3.0, "gyro": 1.0, "odometer_km": 5.0, "speed_mps": 10.0},
        {"ts": 1_800_000, "accel_mps2": -3.5, "gyro": 3.0, "odometer_km": 35.0, "speed_mps": 60.0},
        {"ts": 900_000, "accel_mps2": None, "gyro": None, "odometer_km": 20.0, "speed_mps": 50.0, "posted_speed_limit": None},
        {"trip_id": "single", "accel_mps2": 3.0, "gyro": 1.0},
        {"trip_id": None}, {"driver_id": None},
    )
    got = {r["trip_id"]: r for r in trips.trip_summary(events).collect()}
    assert set(got) == {"t1", "single"}
    t = got["t1"]
    assert (t["ts_min"], t["ts_max"], t["trip_duration_sec"], t["trip_distance_km"]) == (0, 1_800_000, 1800.0, 30.0)
    assert math.isclose(t["avg_speed_calc"], 30 / (0.5 + 1e-6))
    assert math.isclose(t["gyro_std"], math.sqrt(2))
    # strict limits here: exactly -3 is no harsh brake
    assert (t["harsh_brakes"], t["harsh_accels"], t["overspeed_events"]) == (1, 0, 1)
    assert got["single"]["gyro_std"] is None and got["single"]["harsh_accels"] == 0


def feature_rows(df):
    return {
        r["driver_id"]: tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()
    }


def test_features_agree_in_one_pass_and_with_trips(make_events):
    events = make_events(
        {"accel_mps2": -3.0}, {"accel_mps2": None, "odometer_km": 130.0}, {"trip_id": "t2", "speed_mps": 70.0},
        {"trip_id": "t2", "odometer_km": 101.0}, {"trip_id": None, "odometer_km": 900.0, "speed_mps": 1.0},
        {"driver_id": "d2", "posted_speed_limit": None}, {"driver_id": None},
    )
    one_pass = feature_rows(features.driver_features_in_one_pass(events))
    with_trips = feature_rows(features.driver_features(events, trips.trip_summary(events)))
    assert one_pass == with_trips
    d1 = one_pass["d1"]
    assert d1[1:3] == (2, 5)  # the event without trip counts as event, not as trip
    assert d1[5] == 0.2  # a missing acceleration stays in the denominator
    assert d1[10] == 31.0
    assert one_pass["d2"][4] is None  # deviation of one reading


def test_distance_without_trips(make_events):
    events = make_events({"odometer_km": 10.0}, {"odometer_km": 25.0, "trip_id": "t2"})
    assert features.driver_features(events).first()["total_km"] == 15.0


def test_unknown_distances_sum_to_zero(spark):
    df = spark.createDataFrame([("d", "t", None)], "driver_id string, trip_id string, trip_distance_km double")
    assert features.total_km_from_trips(df).first()["total_km"] == 0.0


def test_driver_without_trips_keeps_row(make_events, spark):
    km = spark.createDataFrame([("other", 5.0)], "driver_id string, total_km double")
    row = features.add_total_km(features.driver_event_features(make_events({})), km).first()
    assert row["driver_id"] == "d1" and row["total_km"] is None


def test_join_form_of_trip_counts(spark):
    all_trips = spark.createDataFrame([("d", "a"), ("d", "b")], "driver_id string, trip_id string")
    counts = spark.createDataFrame([("d", "a", 4)], "driver_id string, trip_id string, harsh_brakes bigint")
    got = trips.attach_trip_counts(all_trips, counts, ["harsh_brakes"]).collect()
    assert {(r["trip_id"], r["harsh_brakes"]) for r in got} == {("a", 4), ("b", 0)}


def test_trip_columns_can_be_filled(make_events):
    events = conform(
        make_events({"ts": 0}, {"ts": 60_000, "odometer_km": 103.0}).withColumn("event_date", F.lit("1970-01-01")),
        SILVER_EVENTS,
    )
    filled = trips.fill_trip_columns(events, trips.trip_summary(events))
    assert filled.columns == events.columns
    assert {(r["trip_distance_km"], r["trip_duration_sec"]) for r in filled.collect()} == {(3.0, 60)}
