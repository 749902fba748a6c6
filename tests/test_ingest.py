import hashlib
import hmac
import json

import pytest
from conftest import EVENT
from pyspark.sql import functions as F

from milemark.operators import ingest
from milemark.operators.monitoring import outcome_counters
from milemark.plans import medallion
from milemark.session import scratch_path
from milemark.sources import readers
from milemark.streaming import ingest as streaming

SECRET = "top"


def request(no, at, event, secret=SECRET, body=None):
    text = body or json.dumps({k: v for k, v in event.items() if v is not None})
    return (no, at, text, hmac.new(secret.encode(), text.encode(), hashlib.sha256).hexdigest())


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([("d1", SECRET)], "driver_id string, secret string")


@pytest.fixture(scope="module")
def rows():
    base = 1_700_000_000_000
    out = [
        request(0, base, EVENT),
        request(1, base + 1, EVENT),  # same id again
        request(2, base + 2, {**EVENT, "event_id": "bad", "lat": 99.0}),
        request(3, base + 3, {**EVENT, "event_id": "bad"}),  # an id counts as seen though it was rejected
        request(4, base + 4, {**EVENT, "event_id": "x4"}, secret="wrong"),
        request(5, base + 5, {**EVENT, "event_id": "x5", "driver_id": "stranger"}),
        request(6, base + 6, EVENT, body="{not json"),
        request(7, base + 7, {**EVENT, "event_id": "x7", "speed_mps": "fast"}),
    ]
    # eighteen more use up the rate limit (three were admitted above), then one too many, then a pause
    out += [request(10 + i, base + 10 + i, {**EVENT, "event_id": f"r{i}"}) for i in range(18)]
    out.append(request(90, base + 5_000, {**EVENT, "event_id": "later"}))
    return out


def test_stage_order(spark, keys, rows):
    df = spark.createDataFrame(rows, streaming.REQUESTS)
    got = {r["arrival_no"]: (r["outcome"], r["reason"]) for r in ingest.classify(df, keys).collect()}
    assert len(got) == len(rows)
    assert got[0] == ("ACCEPTED", "OK")
    assert got[1] == got[3] == ("DUPLICATE_EVENT", "DUPLICATE_EVENT")
    assert got[2] == ("REJECTED", "LAT_LON_OUT_OF_RANGE")
    assert got[4] == got[5] == ("UNAUTHORIZED", "UNAUTHORIZED")
    assert got[6] == ("INVALID_JSON", "INVALID_JSON")
    assert got[7] == ("REJECTED", "SCHEMA_VALIDATION_FAILED")
    # 0, 2 and 7 count towards the limit of twenty
    assert [got[10 + i][0] for i in range(18)] == ["ACCEPTED"] * 17 + ["RATE_LIMIT_EXCEEDED"]
    assert got[90] == ("ACCEPTED", "OK")


def test_rate_limit_can_be_switched_off(spark, keys, rows):
    df = spark.createDataFrame(rows, streaming.REQUESTS)
    got = ingest.classify(df, keys, rate_limited=False)
    assert got.filter("outcome = 'RATE_LIMIT_EXCEEDED'").count() == 0


def test_batch_and_stream_write_the_same(spark, keys, rows):
    base = scratch_path(spark, "ingest-test")
    df = spark.createDataFrame(rows, streaming.REQUESTS).coalesce(1)
    medallion.ingest_batch(df, keys, f"{base}/batch/bronze", f"{base}/batch/dlq")
    # the stream gets them in three micro-batches, in order of arrival
    for part in (rows[:5], rows[5:20], rows[20:]):
        spark.createDataFrame(part, streaming.REQUESTS).coalesce(1).write.mode("append").json(f"{base}/in")
    stream = streaming.request_stream(spark, f"{base}/in", 1)
    streaming.finish(streaming.ingest_stream(stream, keys, f"{base}/s", f"{base}/checkpoint"))

    def bronze(path):
        return sorted(r["event_id"] for r in readers.read_raw_events(spark, path).collect())

    def letters(path):
        return sorted((r["event_id"], r["_dlq_reason"], r["_original"]) for r in readers.read_dead_letters(spark, path).collect())

    assert bronze(f"{base}/batch/bronze") == bronze(f"{base}/s/bronze")
    assert letters(f"{base}/batch/dlq") == letters(f"{base}/s/dead_letters")
    assert [x[:2] for x in letters(f"{base}/batch/dlq")] == [("bad", "LAT_LON_OUT_OF_RANGE"), ("x7", "SCHEMA_VALIDATION_FAILED")]
    assert '"fast"' in letters(f"{base}/s/dead_letters")[1][2]
    counters = {r["counter"]: r["n"] for r in streaming.stream_counters(spark, f"{base}/s").collect()}
    batch = {r["counter"]: r["n"] for r in outcome_counters(ingest.classify(df, keys)).collect()}
    assert counters == batch


def test_late_rows_and_rows_without_id_have_an_outcome(spark, keys):
    base = scratch_path(spark, "late")
    start = 1_700_000_000_000
    no_id = {**EVENT, "event_id": None}
    batches = [
        [request(1, start + 10_000_000, EVENT), request(2, start + 10_000_001, no_id)],
        [request(3, start, {**EVENT, "event_id": "late"}), request(4, start + 1, no_id), request(5, start + 2, EVENT)],
        [request(6, start + 3, {**EVENT, "event_id": "late"}), request(7, start + 20_000_000, no_id)],
    ]
    for part in batches:
        spark.createDataFrame(part, streaming.REQUESTS).coalesce(1).write.mode("append").json(f"{base}/in")
    stream = streaming.request_stream(spark, f"{base}/in", 1)
    streaming.finish(streaming.ingest_stream(stream, keys, f"{base}/s", f"{base}/checkpoint"))
    outcomes = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/s/outcomes")
    got = {r["arrival_no"]: r["outcome"] for r in outcomes.collect()}
    assert got == {
        1: "ACCEPTED", 2: "REJECTED", 3: "ACCEPTED", 4: "REJECTED", 5: "DUPLICATE_EVENT", 6: "DUPLICATE_EVENT", 7: "REJECTED",
    }
    assert readers.read_dead_letters(spark, f"{base}/s/dead_letters").count() == 3


def test_stream_limiter_remembers_between_batches(spark):
    base = scratch_path(spark, "limiter")
    start = 1_700_000_000_000
    for part, offsets in enumerate([range(0, 15), range(15, 30), [1_000]]):
        lines = [(part * 100 + i, start + o, "{}", "") for i, o in enumerate(offsets)]
        spark.createDataFrame(lines, streaming.REQUESTS).coalesce(1).write.mode("append").json(f"{base}/in")
    stream = streaming.request_stream(spark, f"{base}/in", 1).withColumn("driver_id", F.lit("d"))
    narrow = stream.select("arrival_no", "arrival_ms", "driver_id")
    streaming.finish(streaming.limit_rate_stream(narrow, base, f"{base}/checkpoint"))
    got = spark.read.parquet(f"{base}/decided")
    assert got.count() == 31
    assert got.filter("accepted").count() == 20  # the last arrival is exactly one second after the first
    assert spark.read.parquet(f"{base}/recent/batch=2").count() == 20


def test_malformed_and_partial_bodies(spark):
    bodies = ["{", "[1, 2]", '{"event_id": "a", "lat": 1}', '{"event_id": 5, "lat": "north"}', None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, body string")
    got = {r["n"]: r for r in ingest.parse_events(df).collect()}
    assert not got[0]["is_json"] and not got[4]["is_json"]
    assert got[2]["is_json"] and got[2]["lat"] == 1.0 and got[2]["_schema_ok"]
    assert got[3]["is_json"] and not got[3]["_schema_ok"]


def request_tables(spark, n, at_ms):
    """Requests of two drivers with devices, all at one event time and too far apart for the rate limit."""
    path = scratch_path(spark, "requests")
    spark.createDataFrame([(1,), (2,)], "c_custkey long").write.parquet(f"{path}/customer.parquet")
    spark.range(n).select(
        (F.col("id") * 1001).alias("event_id"), F.timestamp_millis(F.lit(at_ms)).alias("ts"), (F.col("id") % 2 + 1).alias("user_id")
    ).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("at_ms, kind", [(8_000_000_000_000_000, "decimal(38,0)"), (1_700_000_000_000, "bigint")])
def test_sums_of_a_batch_stay_whole_beyond_a_bigint(spark, at_ms, kind):
    from milemark.catalog import ingest as catalog

    found = catalog.jb1(spark, request_tables(spark, 12000, at_ms))
    rows = found.collect()
    assert dict(found.dtypes)["ts_sum"] == kind
    assert max(r["n"] for r in rows) > 1200 and all(int(r["ts_sum"]) == r["n"] * at_ms for r in rows)


def test_sums_of_nothing_and_of_nulls(spark):
    from milemark.catalog.ingest import _with_whole_sums

    rows = spark.createDataFrame([("a", None), ("b", 2**63 - 1), ("b", -1)], "k string, v long")
    found = _with_whole_sums(rows.groupBy("k"), "v", "total")
    assert {tuple(r) for r in found.collect()} == {("a", 1, None), ("b", 2, 2**63 - 2)} and found.schema["total"].dataType.simpleString() == "bigint"
    assert _with_whole_sums(rows.where("false").groupBy("k"), "v", "total").count() == 0
