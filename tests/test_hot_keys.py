"""Left joins in which rows of a frequent key are dealt to several tasks."""

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.operators.hot_keys import join_spread


def test_join_spread_equals_a_left_join(spark):
    rows = [(i, k) for i, k in enumerate(["hot"] * 90 + ["rare", "rare", "unknown", None, None] + ["twice"] * 20)]
    left = spark.createDataFrame(rows + rows[:3] + rows[-3:], "n int, key string")
    table = spark.createDataFrame([("hot", 1), ("rare", 2), ("twice", 3), ("twice", 4), ("idle", 5), (None, 6)], "key string, v int")
    order = lambda df: sorted(map(str, df.select("n", "key", "v").collect()))
    assert order(join_spread(left, table, "key", share_rows=10)) == order(left.join(table, "key", "left"))
    assert join_spread(left.limit(0), table, "key").count() == 0


def test_a_busy_key_goes_to_several_tasks(spark):
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        rows = spark.range(4000).select("id", F.lit("hot").alias("key"))
        joined = join_spread(rows, spark.createDataFrame([("hot", 1)], "key string, v int"), "key", share_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 1000
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lineitem_is_dealt_out_once(spark, small):
    """By the key of its join, so that no second exchange of the rows follows."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = inputs.telemetry(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # one for each table
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
