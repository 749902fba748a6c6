"""Event-time windows on tables and streams of a few rows."""

from datetime import datetime, timedelta

import pytest

from milemark.streaming.ingest import finish
from milemark.streaming.windows import Windows, activity, count_late, write_activity

START = datetime(2024, 5, 1)
SCHEMA = "driver_id string, event_at timestamp, speed_mps double"


def rows(*minutes, driver="d"):
    return [(driver, START + timedelta(minutes=m), float(m)) for m in minutes]


def found(df):
    return sorted((r.driver_id, (r.opens - START) / timedelta(minutes=1), (r.closes - START) / timedelta(minutes=1), r.n, r.most) for r in df.collect())


def test_windows_of_a_table(spark):
    df = spark.createDataFrame(rows(0, 4, 9, 30) + [(None, START, 1.0), ("d", None, 1.0)], SCHEMA)
    assert found(activity(df, Windows(size="10 minutes"))) == [("d", 0, 10, 3, 9.0), ("d", 30, 40, 1, 30.0)]
    assert found(activity(df.where("speed_mps < 5"), Windows(size="10 minutes", slide="5 minutes"))) == [("d", -5, 5, 2, 4.0), ("d", 0, 10, 2, 4.0)]
    assert found(activity(df, Windows(gap="4 minutes"))) == [("d", 0, 8, 2, 4.0), ("d", 9, 13, 1, 9.0), ("d", 30, 34, 1, 30.0)]
    assert found(activity(df, Windows(gap="6 minutes"))) == [("d", 0, 15, 3, 9.0), ("d", 30, 36, 1, 30.0)]


def test_specs_that_make_no_windows():
    for spec in ({}, {"size": "1 hour", "gap": "1 hour"}, {"gap": "1 hour", "slide": "5 minutes"}, {"slide": "5 minutes"}):
        with pytest.raises(ValueError):
            Windows(**spec)


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    """Open windows wait in the state; late rows take part in no window and are counted apart."""
    windows, source = Windows(size="10 minutes"), f"{tmp_path}/in"

    def run(batch):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        finish(write_activity(stream, windows, f"{tmp_path}/out", f"{tmp_path}/c1", "5 minutes"))
        finish(count_late(stream, windows, f"{tmp_path}/counts", f"{tmp_path}/c2", "5 minutes"))
        return found(spark.read.schema(activity(stream, windows).schema).parquet(f"{tmp_path}/out"))

    assert run(rows(1, 8)) == []
    assert run(rows(22, 3)) == [("d", 0, 10, 3, 8.0)]
    # the first window has closed; the third is open
    closed = run(rows(5, 29, 24) + rows(2, driver="e") + [("e", None, 1.0)])
    assert closed == [("d", 0, 10, 3, 8.0)]
    assert run(rows(60)) == [("d", 0, 10, 3, 8.0), ("d", 20, 30, 3, 29.0)]
    late = spark.read.parquet(f"{tmp_path}/counts/late").collect()
    assert sorted((r.driver_id, r.n_late, r.furthest_ms) for r in late) == [("d", 1, 420_000), ("e", 1, 420_000)]
