"""Bounded samples of labelled rows, taken without sending every partition's rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashes are cut at this many even steps.
STEPS = 1 << 30


def smallest_hashes(ids: DataFrame, most: int, total: int, id_col: str = "doc_id") -> DataFrame:
    """Of ``total`` rows the ``most`` with the smallest hash of the id.

    Rows above a threshold of the hash go first, so about 1.5 times ``most`` rows meet in the final order, whatever the
    number of partitions; the threshold keeps ``most`` rows but for a chance too small to matter, and then takes fewer.
    """
    step = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(STEPS))
    share = min(1.0, (1.5 * most + 100) / max(total, 1))
    near = ids.withColumn("_step", step).where(F.col("_step") < int(share * STEPS) if share < 1 else F.lit(True))
    return near.orderBy("_step", id_col).limit(most).drop("_step")


def agreed(labels: DataFrame, value: str, train: Column, id_col: str = "doc_id") -> DataFrame:
    """(id, value) of the ids to learn from; ids without a value, or whose values differ, are left out."""
    rows = labels.where(F.coalesce(train, F.lit(False)) & F.col(value).isNotNull() & F.col(id_col).isNotNull())
    both = rows.groupBy(id_col).agg(F.min(value).alias("least"), F.max(value).alias("most"))
    return both.where("least = most").select(id_col, F.col("least").alias(value))
