"""Sliced windows and prefix sums against plain loops, with one key holding most rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from milemark.operators import arrivals, distribution, ordered, trips


def test_sessions_do_not_depend_on_slices(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"d{rng.randrange(4)}", rng.randrange(500) * 1000, i) for i in range(400)]
    df = spark.createDataFrame(rows, "driver_id string, ts bigint, event_id bigint")
    expected = {}
    for driver in {r[0] for r in rows}:
        seq, last = 0, None
        for _, ts, event in sorted((r for r in rows if r[0] == driver), key=lambda r: (r[1], r[2])):
            if last is None or ts - last > 3000:
                seq += 1
            last = ts
            expected[event] = seq
    for slice_ms in (1_000, 7_000, 10_000_000):
        got = ordered.sessionize(df, max_gap_ms=3000, slice_ms=slice_ms).collect()
        assert {r["event_id"]: r["session_seq"] for r in got} == expected


def test_session_gap_is_exclusive(spark):
    df = spark.createDataFrame([("d", 0, 1), ("d", 300_000, 2), ("d", 600_001, 3)], "driver_id string, ts bigint, event_id bigint")
    got = {r["event_id"]: r["session_seq"] for r in ordered.sessionize(df).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_odometer_against_running_maximum(spark):
    rng = random.Random(2)
    rows = [("d", "hot" if rng.random() < 0.8 else "t", rng.randrange(10_000), i, f"e{i}",
             None if rng.random() < 0.1 else float(rng.randrange(100))) for i in range(300)]
    df = spark.createDataFrame(
        rows, "driver_id string, trip_id string, ts bigint, event_seq_no int, event_id string, odometer_km double"
    )
    expected, reached = {}, {}
    for _, trip, ts, seq, event, km in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[4])):
        top = reached.get(trip)
        expected[event] = km is not None and top is not None and km < top
        if km is not None and (top is None or km > top):
            reached[trip] = km
    for slice_ms in (50, 1_000_000):
        got = trips.flag_odometer(df, slice_ms).collect()
        assert {r["event_id"]: r["odometer_backwards"] for r in got} == expected
    assert trips.monotonic_odometer(df, 50).count() == sum(not bad for bad in expected.values())


@pytest.mark.parametrize("partitions", [2, 16])
def test_quantiles_match_numpy(spark, partitions):
    rng = np.random.default_rng(3)
    values = pd.DataFrame({"a": rng.integers(0, 20, 500).astype(float), "b": rng.normal(size=500)})
    values.loc[:250, "a"] = 7.0  # one value holds half of the rows
    values.loc[::9, "b"] = np.nan
    df = spark.createDataFrame(values).select("a", F.when(~F.isnan("b"), F.col("b")).alias("b"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["column"]: r for r in ordered.exact_quantiles(df, ["a", "b"], [0, 0.1, 0.5, 0.99, 1]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for c in ("a", "b"):
        known = values[c].dropna()
        assert got[c]["n"] == len(known)
        expected = np.quantile(known, [0, 0.1, 0.5, 0.99, 1])
        assert np.allclose([got[c][f"q{i}"] for i in range(5)], expected)


def test_bucket_search_over_thousands_of_edges(spark):
    from bisect import bisect_right

    rng = random.Random(8)
    edges = sorted({rng.uniform(-1e3, 1e3) for _ in range(4000)})
    values = [*edges[::37], *(rng.uniform(-1100, 1100) for _ in range(500)), float("inf"), float("-inf"), float("nan"), None, 0.0, -0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for cuts in (edges, edges[:1], []):
        placed = ordered.with_bucket(df, "v", cuts)
        assert placed.columns == ["i", "v", "_bucket"]
        wanted = [len(cuts) if v is None or v != v else bisect_right(cuts, v) for v in values]
        assert [r["_bucket"] for r in placed.orderBy("i").collect()] == wanted
    plan = ordered.with_bucket(df, "v", edges)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 10_000  # the edges are data, not expressions


def test_ranges_hold_all_rows_in_order(spark):
    df = spark.createDataFrame([(k, float(v % 97), v) for k in "ab" for v in range(500)] + [("c", None, 1)], "k string, v double, n long")
    counts = df.groupBy("k", "v").agg(F.sum("n").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = ordered.ranged(counts, ["k", "v"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 2 * 97 + 1
    in_order = sorted(rows, key=lambda r: (r.k, r.v is not None, r.v or 0.0))
    assert [r["_bucket"] for r in in_order] == sorted(r["_bucket"] for r in rows) and len({r["_bucket"] for r in rows}) > 1


def test_statistics_match_pandas(spark):
    rng = np.random.default_rng(4)
    values = pd.DataFrame({"a": rng.normal(size=200), "b": rng.exponential(size=200), "k": 5.0})
    df = spark.createDataFrame(values)
    got = distribution.describe(df, ["a", "b"]).toPandas().set_index("column")
    expected = values[["a", "b"]].describe().T
    for mine, theirs in {"mean": "mean", "std": "std", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
        assert np.allclose(got.loc[["a", "b"], mine], expected[theirs])
    r = {(x["x"], x["y"]): x["r"] for x in distribution.correlations(df, ["a", "b", "k"]).collect()}
    assert np.isclose(r["a", "b"], values["a"].corr(values["b"])) and r["b", "a"] == r["a", "b"]
    assert np.isclose(r["a", "a"], 1) and r["a", "k"] is None
    profile = {x["column"]: x for x in distribution.profile(df, ["b", "k"]).collect()}
    assert profile["k"]["is_constant"] and profile["k"]["cardinality"] == 1 and profile["b"]["is_skewed"]
    q1, q3 = np.quantile(values["b"], [0.25, 0.75])
    outside = (values["b"] < q1 - 1.5 * (q3 - q1)) | (values["b"] > q3 + 1.5 * (q3 - q1))
    assert profile["b"]["outliers"] == outside.sum()


def test_histogram_covers_all_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)], "x double")
    got = {r["bin"]: r["n"] for r in distribution.histogram(df, "x", bins=4).collect()}
    assert got == {0: 25, 1: 25, 2: 25, 3: 25}
    constant = spark.createDataFrame([(2.0,)] * 3, "x double")
    assert [tuple(r) for r in distribution.histogram(constant, "x").collect()] == [(0, 3)]


def test_top_values_and_counts(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("c",), (None,)], "x string")
    got = [(r["value"], r["n"]) for r in distribution.top_values(df, ["x"], 2).orderBy("rank").collect()]
    assert got == [("a", 3), ("b", 3)]
    shares = {r["value"]: r["share"] for r in distribution.value_counts(df, "x").collect()}
    assert shares == {"a": 3 / 7, "b": 3 / 7, "c": 1 / 7}


# --- arrivals ---


def plain_limit(rows, limit, window):
    verdicts, recent = {}, {}
    for driver, at, no in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        kept = [t for t in recent.get(driver, []) if t >= at - window]
        verdicts[no] = len(kept) < limit
        recent[driver] = kept + [at] if verdicts[no] else kept
    return verdicts


def traffic(seed, n, kind):
    rng = random.Random(seed)
    rows, at = [], 0
    for no in range(n):
        if kind == "flood":  # one driver, always above the limit
            at += rng.randrange(20)
            rows.append(("hot", at, no))
        elif kind == "bursts":
            at += rng.randrange(15) if no % 60 else 5_000
            rows.append((f"d{rng.randrange(2)}", at, no))
        else:
            rows.append((f"d{rng.randrange(3)}", rng.randrange(60_000), no))
    return rows


@pytest.mark.parametrize("kind", ["flood", "bursts", "mixed"])
def test_rate_limit_matches_a_plain_loop(spark, kind):
    rows = traffic(5, 900, kind)
    df = spark.createDataFrame(rows, "driver_id string, arrival_ms bigint, arrival_no bigint")
    expected = plain_limit(rows, 5, 300)
    for slice_ms in (301, 1_000, 60_000):
        got = arrivals.rate_limit(df, limit=5, window_ms=300, slice_ms=slice_ms).collect()
        assert len(got) == len(rows)
        assert {r["arrival_no"]: r["accepted"] for r in got} == expected, (kind, slice_ms)


def test_rate_limit_window_is_closed(spark):
    rows = [("d", 1_000 + i, i) for i in range(21)] + [("d", 2_000, 21), ("d", 2_001, 22)]
    df = spark.createDataFrame(rows, "driver_id string, arrival_ms bigint, arrival_no bigint")
    got = {r["arrival_no"]: r["accepted"] for r in arrivals.rate_limit(df).collect()}
    assert got[19] and not got[20]  # the 21st within a second
    assert not got[21]  # exactly one second after the first: the first still counts
    assert got[22]


def test_quiet_traffic_never_reaches_python(spark):
    df = spark.createDataFrame([("d", i * 1000, i) for i in range(50)], "driver_id string, arrival_ms bigint, arrival_no bigint")
    assert arrivals.rate_limit(df).filter("accepted").count() == 50


def test_duplicates_marked_by_arrival(spark):
    df = spark.createDataFrame([("x", 3, 3), ("x", 1, 1), ("y", 2, 2), ("x", 1, 0)], "event_id string, at bigint, no bigint")
    got = {r["no"]: r["is_duplicate"] for r in arrivals.mark_duplicates(df, ["at", "no"]).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}
