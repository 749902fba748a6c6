"""A table's profile kept up to date: every load adds a small part, and the profile is read off the parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.operators import sketches

PARTS = (
    "`column` string, rows long, known long, mean double, m2 double, m3 double, `min` double, `max` double,"
    " quantiles binary, distinct binary, load string"
)


def add_load(df: DataFrame, numeric: list[str], path: str, load: str) -> None:
    """Profile the rows of one load; a load that is added again replaces its part."""
    part = sketches.profile_part(df, numeric).withColumn("load", F.lit(load)).coalesce(1)  # one row per column
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)


def current(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame:
    """The profile over all loads, or the named ones; reads parts, never rows of the table."""
    parts = spark.read.schema(PARTS).parquet(path)
    if loads is not None:
        parts = parts.where(F.col("load").isin(loads))
    return sketches.profile_of(sketches.merge_parts(parts))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """All parts as one, written to ``target``: what later loads are added to."""
    merged = sketches.merge_parts(spark.read.schema(PARTS).parquet(path))
    merged.withColumn("load", F.lit("compacted")).coalesce(1).write.partitionBy("load").parquet(target)
