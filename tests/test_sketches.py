"""Mergeable profiles against exact ones: moments, rank errors, cardinality, odd columns, loads added twice."""

import random

import numpy as np
import pytest

from milemark.operators import sketches
from milemark.plans import profiles

COLUMNS = ["a", "b", "c", "d", "e"]
SCHEMA = "a double, b double, c double, d double, e int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    skewed = lambda: rng.expovariate(0.01) + 1e6
    return [
        (skewed(), rng.choice([None, float("nan"), rng.gauss(0, 1)]), 7.0, None, i % 300 if i % 9 else None)
        for i in range(20000)
    ]


def parts_of(spark, rows, cuts, path):
    for i, (begin, end) in enumerate(zip(cuts, cuts[1:])):
        profiles.add_load(spark.createDataFrame(rows[begin:end], SCHEMA), COLUMNS, path, f"load{i}")


def held(rows, c):
    i = COLUMNS.index(c)
    return np.array(sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i]), float)


def assert_profile(found, rows):
    assert sorted(found) == COLUMNS
    for c in COLUMNS:
        x, row = held(rows, c), found[c]
        assert row["rows"] == len(rows)
        assert row.missing_pct == pytest.approx(100 * (len(rows) - len(x)) / len(rows))
        if not len(x):
            assert row.mean is row.variance is row.skewness is row.q1 is row["min"] is None
            assert row.cardinality == 0 and row.is_constant and not row.has_outliers
            continue
        d = x - x.mean()
        assert row.mean == pytest.approx(x.mean(), rel=1e-12)
        assert row.variance == pytest.approx((d**2).sum() / (len(x) - 1), rel=1e-9, abs=1e-12)
        assert (row["min"], row["max"]) == (x[0], x[-1])
        assert abs(row.cardinality - len(set(x))) <= max(1, 0.05 * len(set(x)))
        if x[0] == x[-1]:
            assert row.skewness is None and row.is_constant
        else:
            assert row.skewness == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5, rel=1e-6, abs=1e-9)
        for q, value in ((0.25, row.q1), (0.5, row.median), (0.75, row.q3)):
            low, high = np.searchsorted(x, value, "left") / len(x), np.searchsorted(x, value, "right") / len(x)
            assert low - 0.01 <= q <= high + 0.01


def test_merged_profile_is_that_of_all_rows(spark, rows, tmp_path):
    path = str(tmp_path / "parts")
    parts_of(spark, rows, [0, 10, 11, 4000, 20000], path)
    assert_profile({r.column: r for r in profiles.current(spark, path).collect()}, rows)
    # some loads only
    some = {r.column: r for r in profiles.current(spark, path, ["load0", "load2"]).collect()}
    assert_profile(some, rows[:10] + rows[11:4000])
    # added again, with the same rows: nothing counts twice
    parts_of(spark, rows, [0, 10], path)
    assert {r["rows"] for r in profiles.current(spark, path).collect()} == {20000}
    # compacted, and one load more
    target = str(tmp_path / "compacted")
    profiles.compact(spark, path, target)
    profiles.add_load(spark.createDataFrame(rows[:500], SCHEMA), COLUMNS, target, "later")
    assert_profile({r.column: r for r in profiles.current(spark, target).collect()}, rows + rows[:500])


def test_no_rows_have_no_profile(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sketches.profile_of(sketches.merge_parts(sketches.profile_part(empty, COLUMNS))).collect() == []


def test_a_part_is_small(spark):
    part = sketches.profile_part(spark.range(300_000).selectExpr("rand(3) AS a"), ["a"]).first()
    assert len(part.quantiles) + len(part.distinct) < 32_000
