import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from milemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest given tables."""
    return "/root/testdata/sf0.001"


EVENT = {
    "event_id": "e1", "driver_id": "d1", "trip_id": "t1", "ts": 1_700_000_000_000, "ingestion_ts": 1_700_000_000_500,
    "event_seq_no": 0, "lat": 10.0, "lon": 20.0, "speed_mps": 12.0, "accel_mps2": 0.5, "gyro": 0.1, "heading": 90.0,
    "odometer_km": 100.0, "source": "phone", "driver_age_band": "UNDER25", "license_years": 3, "accidents_count": 0,
    "claims_count": 0, "violation_points": 0, "policy_tenure_years": 1, "vehicle_make": "M", "vehicle_model_year": 2015,
    "safety_rating": 4.5, "vehicle_vin_hash": "h", "vehicle_type": "SUV", "ownership_type": "OWNED", "weather": "clear",
    "road_type": "urban", "posted_speed_limit": 50, "crime_index": 0.5, "accident_index": 0.5,
}


@pytest.fixture(scope="session")
def make_events(spark):
    """Events in the contract, each given as the columns that differ from a valid one."""
    from pyspark.sql import types as T

    from milemark.schemas import EVENTS

    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in EVENTS.fields])

    def make(*changes):
        rows = []
        for i, change in enumerate(changes):
            row = {**EVENT, "event_id": f"e{i}", **change}
            rows.append(tuple(row[f.name] for f in EVENTS.fields))
        return spark.createDataFrame(rows, nullable)

    return make
