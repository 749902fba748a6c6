"""Layers by load against the batch jobs, and what a load reads."""

import random

import pytest
from pyspark.sql import functions as F

from milemark.operators import partials, trips
from milemark.plans import incremental, medallion
from milemark.schemas import EVENTS, SILVER_EVENTS, conform
from milemark.sources import readers


def events(spark, rows):
    """(event_id, driver_id, trip_id, ts, ingestion_ts, speed, odometer)"""
    names = ["event_id", "driver_id", "trip_id", "ts", "ingestion_ts", "speed_mps", "odometer_km"]
    frame = spark.createDataFrame(rows, "event_id string, driver_id string, trip_id string, ts long, ingestion_ts long, speed_mps double, odometer_km double")
    fixed = {"lat": 1.0, "lon": 2.0, "accel_mps2": 0.5, "gyro": 0.1, "source": "phone", "driver_age_band": "OVER60", "vehicle_type": "SUV",
             "ownership_type": "OWNED", "weather": "rain", "road_type": "urban", "posted_speed_limit": 50}
    assert names == frame.columns
    return conform(frame.withColumns({k: F.lit(v) for k, v in fixed.items()}), EVENTS)


def drawn(rng, n, drivers, first=0):
    out = []
    for i in range(first, first + n):
        driver = f"d{rng.choice(drivers)}"
        out.append((f"e{i}", driver, rng.choice([f"{driver}-t{i % 3}", None]), 1000 * i, 5000 * i, rng.choice([None, float(i % 50)]), float(i)))
    return out


def gold_rows(df):
    return sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def batch(spark, path, base):
    medallion.bronze_to_silver(spark, path, f"{base}/events", f"{base}/trips")
    return gold_rows(medallion.silver_to_gold(spark, f"{base}/events", f"{base}/gold", f"{base}/trips"))


def test_loads_equal_one_batch_and_touch_only_their_buckets(spark, tmp_path):
    rng = random.Random(6)
    base, raw = f"{tmp_path}/lake", f"{tmp_path}/raw"
    first = drawn(rng, 400, range(30))
    second = drawn(rng, 200, range(20, 40), 400) + first[::9] + [(None, "d1", None, 5, 9_000_000, 1.0, 1.0)] * 2
    third = [("late", "d7", "d7-t0", 77, 10_000_000, 44.0, 900.0)] + first[:1]
    loads = []
    for k, rows in enumerate((first, second, third)):
        events(spark, rows).write.parquet(f"{raw}/{k}")
        if k == 1:  # an unfinished run of the load leaves files behind
            incremental._write(spark.createDataFrame([("stray", 0)], "event_id string, bucket int"), base, "ids", 1)
        loads.append(incremental.take_load(spark, f"{raw}/{k}", base, k, buckets=16, compact_every=2))
    touched = loads[2]["gold"]
    assert len(touched) == 1 and len(loads[2]["ids"]) == 1 and len(loads[0]["gold"]) > 5
    held = incremental.read_manifest(spark, base, 2)
    before = incremental.read_manifest(spark, base, 1)
    for layer in ("gold", "partials", "ids"):
        assert {b for b in held[layer] if held[layer][b] != before[layer].get(b)} == set(loads[2][layer])
    assert all(len(found) < 2 + 1 for layer in ("partials", "ids") for found in held[layer].values())
    # what the load read of the partials are folders of its own buckets
    paths = incremental.folders(base, "partials", held["partials"], touched)
    assert paths and all(p.endswith(f"bucket={touched[0]}") for p in paths)
    found = gold_rows(incremental.read_gold(spark, base, 2))
    for k in range(3):
        readers.read_raw_events(spark, f"{raw}/{k}").write.mode("append").parquet(f"{tmp_path}/all")
    assert found == batch(spark, f"{tmp_path}/all", f"{tmp_path}/once")
    again = incremental.take_load(spark, f"{raw}/2", base, 2, buckets=16, compact_every=2)
    assert again == loads[2] and gold_rows(incremental.read_gold(spark, base, 2)) == found


def test_load_without_new_events(spark, tmp_path):
    base = f"{tmp_path}/lake"
    events(spark, drawn(random.Random(1), 20, range(3))).write.parquet(f"{tmp_path}/a")
    incremental.take_load(spark, f"{tmp_path}/a", base, 0)
    before = gold_rows(incremental.read_gold(spark, base, 0))
    assert incremental.take_load(spark, f"{tmp_path}/a", base, 1) == {"ids": [], "partials": [], "gold": []}
    assert gold_rows(incremental.read_gold(spark, base, 1)) == before


@pytest.mark.parametrize("cuts", [1, 4])
def test_partials_add_up_over_any_split(spark, cuts):
    rng = random.Random(cuts)
    df = conform(events(spark, drawn(rng, 300, range(3))).withColumn("event_date", F.lit("2024-01-01")), SILVER_EVENTS).cache()
    parts = [partials.trip_partials(df.where(f"ts div 1000 % {cuts} = {k}")) for k in range(cuts)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    got = {(r.driver_id, r.trip_id): r for r in partials.trips_of(partials.merge_partials(whole)).collect()}
    for r in trips.trip_summary(df).collect():
        mine = got[r.driver_id, r.trip_id]
        for c in mine.asDict():
            assert mine[c] == (pytest.approx(r[c], rel=1e-9, abs=1e-7) if isinstance(r[c], float) else r[c]), c
