"""A left join whose tasks stay small however many rows share a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that go to one task.
ROWS_OF_A_SHARE = 50_000


def join_spread(rows: DataFrame, table: DataFrame, key: str, share_rows: int = ROWS_OF_A_SHARE) -> DataFrame:
    """``rows`` left join ``table`` on ``key``, as ``rows.join(table, key, "left")`` gives it.

    Rows of a frequent key are dealt into shares of about ``share_rows`` by a hash of the whole row, and each share meets
    its own copy of the key's rows in ``table``. Keys that do not occur are not copied or shuffled further. ``rows`` is
    passed over twice: a join that its caller has stacked on another by the same key would not be split by Spark.
    """
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    used = counted.select(F.col(key).alias("_key"), F.ceil(F.col("_n") / share_rows).alias("_shares"))
    # one row for each share_rows rows at most
    hot = F.broadcast(used.where("_shares > 1"))
    place = F.xxhash64(*rows.columns)
    dealt = rows.join(hot, rows[key] == hot["_key"], "left").select(
        *[rows[c] for c in rows.columns],
        # rows without a key meet nothing: any task will do
        F.when(rows[key].isNull(), place).otherwise(F.pmod(place, F.coalesce("_shares", F.lit(1)))).alias("_share"),
    )
    copies = table.join(used, table[key] == used["_key"]).select(
        *[table[c] for c in table.columns], F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares") - 1)).alias("_share")
    )
    return dealt.join(copies, [key, "_share"], "left").drop("_share")
