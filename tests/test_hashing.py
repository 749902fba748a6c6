import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from milemark.functions import actuarial, hashing
from milemark.operators import labels
from milemark.operators.ingest import authenticate


def test_hmac_equals_the_standard(spark):
    secrets = [("a", "secret"), ("b", "6\\" * 32), ("c", "k" * 65), ("d", "ключ-é")]
    df = spark.createDataFrame(secrets, "driver_id string, secret string")
    body = '{"x": "é"}'
    got = hashing.hmac_pads(df).select(
        "driver_id", hashing.hmac_sha256(F.col("inner_pad"), F.col("outer_pad"), F.lit(body)).alias("h")
    )
    expected = {d: hmac.new(s.encode(), body.encode(), hashlib.sha256).hexdigest() for d, s in secrets}
    assert {r["driver_id"]: r["h"] for r in got.collect()} == expected


def test_unknown_device_or_missing_signature_is_refused(spark):
    keys = spark.createDataFrame([("a", "s")], "driver_id string, secret string")
    good = hmac.new(b"s", b"{}", hashlib.sha256).hexdigest()
    rows = [("a", "{}", good), ("a", "{}", None), ("a", "{} ", good), ("z", "{}", good), (None, "{}", good)]
    df = spark.createDataFrame(rows, "driver_id string, body string, signature string")
    assert sorted(r["is_authorized"] for r in authenticate(df, keys).collect()) == [False] * 4 + [True]


def test_uniform_is_reproducible_and_even(spark):
    df = spark.range(5000).select(hashing.uniform(F.col("id"), 1, "x").alias("u"))
    row = df.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(row[0] - 0.5) < 0.02 and 0 < row[1] < 0.01 and 0.99 < row[2] < 1
    assert df.repartition(7).agg(F.sum("u")).first()[0] == pytest.approx(df.agg(F.sum("u")).first()[0])


@pytest.mark.parametrize("shape", [2.0, 2.5, 0.5])
def test_gamma_moments(spark, shape):
    df = spark.range(20_000).select(hashing.gamma(F.col("id"), 3, shape, 10.0).alias("x"))
    mean, variance, low = df.agg(F.avg("x"), F.var_samp("x"), F.min("x")).first()
    assert mean == pytest.approx(shape * 10, rel=0.05)
    assert variance == pytest.approx(shape * 100, rel=0.1)
    assert low >= 0


def test_gamma_does_not_depend_on_batches(spark):
    df = spark.range(500)
    draw = hashing.gamma(F.col("id"), 3, 1.7, 1.0).alias("x")
    one = {r["id"]: r["x"] for r in df.coalesce(1).select("id", draw).collect()}
    many = {r["id"]: r["x"] for r in df.repartition(9).select("id", draw).collect()}
    assert one == many


def test_pseudonym_and_config_hash(spark):
    row = spark.range(1).select(hashing.pseudonym(F.lit("driver_00001"), F.lit(3))).first()
    assert row[0] == hashlib.sha1(b"driver_00001-3").hexdigest()[:12]
    config = {"b": 1, "a": {"c": 2}}
    assert hashing.config_fingerprint(config) == hashlib.md5(json.dumps(config, sort_keys=True).encode()).hexdigest()


def test_fingerprint_ignores_order_but_not_values(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "x")], "k string, v string")
    same = hashing.table_fingerprint(df.orderBy(F.desc("k"))).first()
    assert hashing.table_fingerprint(df.repartition(3)).first() == same and same["rows"] == 3
    assert hashing.table_fingerprint(df.fillna("")).first()["data_hash"] != same["data_hash"]
    assert hashing.table_fingerprint(df.union(df.limit(1))).first()["data_hash"] != same["data_hash"]


def test_claim_arithmetic(spark):
    df = spark.createDataFrame(
        [("d", 0.5, 0.25, None, 10, 500.0, 5.0)],
        "driver_id string, harsh_brake_rate double, harsh_accel_rate double, night_trip_ratio double, trip_count int,"
        " total_km double, speed_std double",
    )
    score = df.select(actuarial.risk_score()).first()[0]
    assert score == pytest.approx(0.6 * 0.5 + 0.6 * 0.25 + 0.01)
    assert df.select(actuarial.claim_probability(use_feature_weights=False)).first()[0] == 0.2
    amount = actuarial.claim_amount(F.lit(True), F.lit(100.0), F.col("total_km"), F.col("speed_std"))
    assert df.select(amount).first()[0] == pytest.approx(100 * 1.5 * 1.5)
    assert df.select(actuarial.claim_amount(F.lit(False), F.lit(100.0), F.lit(None), F.lit(None))).first()[0] == 0.0


def test_split_keeps_drivers_together(spark):
    df = spark.range(2000).select((F.col("id") % 500).cast("string").alias("driver_id"), (F.col("id") % 2).alias("label"))
    split = labels.with_split(df)
    per_driver = split.groupBy("driver_id").agg(F.count_distinct("is_test").alias("sides"))
    assert per_driver.filter("sides > 1").count() == 0
    share = split.agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.12 < share < 0.28
    assert labels.split_is_usable(split, "label").first()["usable"]
    assert not labels.split_is_usable(split.withColumn("label", F.lit(0)), "label").first()["usable"]
    assert not labels.split_is_usable(split.limit(9), "label").first()["usable"]


def test_standardize_with_constant(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    assert sorted(tuple(r) for r in labels.standardize(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]
