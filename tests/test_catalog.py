"""The registered queries: names, checks, plans, and a sample of them against SQL."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from check import TABLES, table  # noqa: E402

SURVEYED = (
    [f"src{i}" for i in range(1, 11)] + [f"snk{i}" for i in range(1, 9)] + [f"flt{i}" for i in range(1, 7)]
    + [f"prj{i}" for i in range(1, 8)] + [f"val{i}" for i in range(1, 7)] + [f"fn{i}" for i in range(1, 24)]
    + [f"jn{i}" for i in range(1, 7)] + [f"ag{i}" for i in range(1, 31)] + [f"wn{i}" for i in range(1, 9)]
    + [f"or{i}" for i in range(1, 4)] + [f"st{i}" for i in range(1, 3)] + [f"sm{i}" for i in range(1, 6)]
    + [f"ml{i}" for i in range(1, 15)] + [f"jb{i}" for i in range(1, 11)]
)
SAMPLE = [
    "wn1_keep_first", "val1_first_failure", "ag1_trip_summary", "ag3_driver_features", "ag12_describe",
    "ag20_roc_auc", "ag25_normalized_gini", "wn3_rate_limit", "wn4_sessions", "fn19_signature", "jb8_priced_premiums",
]


def test_every_surveyed_operator_has_a_query():
    names = set(contract.queries())
    missing = [i for i in SURVEYED if not any(n.startswith(f"{i}_") for n in names)]  # some have several
    assert missing == []


def test_checks_belong_to_queries():
    names, checked = set(contract.queries()), set(contract.oracle_sql())
    assert checked <= names
    # the optional text operators are tested against brute force where SQL cannot express them
    assert all(re.match(r"op\d+_|pipeline$", n) for n in names - checked)


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, small, db, name):
    df = contract.queries()[name](spark, small)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(contract.oracle_sql()[name])
    assert mine == table([d[0] for d in cursor.description], cursor.fetchall())


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "driver_id" and df.count() > 0


LAZY = [
    "wn1_keep_first", "flt3_enums_dropped", "val3_silver_report", "ag1_trip_summary", "ag3_driver_features",
    "ag3_driver_features_with_trips", "ag14_histogram", "ag20_roc_auc", "ag25_normalized_gini", "ag26_bootstrap_auc",
    "wn2_duplicates_marked", "wn3_rate_limit", "wn4_sessions", "jn3_device_lookup", "val5_training_consistency",
    "ag8_premium_kpis", "fn22_standardized",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_joins(spark, small, name):
    text = plan(contract.queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_duplicates_are_cut_before_the_shuffle(spark, small):
    text = plan(contract.queries()["wn1_keep_first"](spark, small))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", text)


def test_scans_read_only_what_is_needed(spark, small):
    text = plan(contract.queries()["ag19_regression_metrics"](spark, small))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    text = plan(contract.queries()["fn2_hour"](spark, small))
    assert "l_quantity" not in text and "l_tax" not in text


def test_features_shuffle_by_trip_before_driver(spark, small):
    text = plan(contract.queries()["ag3_driver_features"](spark, small))
    assert text.count("FileScan parquet") == 2  # lineitem and orders, once each
    assert re.search(r"hashpartitioning\(driver_id#\d+, \d+\)[\s\S]*hashpartitioning\(driver_id#\d+, trip_id#\d+, \d+\)", text)


def test_hot_driver_is_split_by_time(spark, small):
    text = plan(contract.queries()["wn4_sessions"](spark, small))
    assert re.search(r"hashpartitioning\(driver_id#\d+, _slice#\d+L?, \d+\)", text)
