"""Layers kept up to date load by load: a load of new event files changes what it touches and reads nothing else.

Below ``base``:

* ``ids``: event ids of all loads, in buckets of the id;
* ``silver``: cleaned new events, by load;
* ``partials``: mergeable aggregates of the new events by (driver, trip), in buckets of the driver;
* ``gold``: driver features, a bucket in the newest load that touched it;
* ``manifest``: after each load one row for each folder that counts (layer, load and bucket). A load is taken once its
  manifest is there; repeating an unfinished one replaces its files.

A load deduplicates its events among themselves and against the ids of the buckets they fall into: the copy loaded first
stays, and in a load the earliest arrival, so loads in order of arrival give what one batch over all files gives. Driver
features of touched buckets come from their partials, which are as many rows as trips, whatever the number of events.
After ``compact_every`` loads the folders of a touched bucket are merged into one, so their number stays bounded.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.operators import cleaning, partials
from milemark.plans import medallion
from milemark.session import Scratch
from milemark.sources import readers

BUCKETS = 64
COMPACT_EVERY = 8
_MANIFEST = "layer string, load long, bucket int"

Folders = dict[str, dict[int, list[int]]]


def bucket_of(key: str, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_manifest(spark: SparkSession, base: str, load: int) -> Folders:
    """By layer and bucket, the loads whose folders count after ``load``; nothing before the first one."""
    found: Folders = {"ids": {}, "partials": {}, "gold": {}}
    if load >= 0:
        # at most compact_every folders for each layer and bucket
        for row in spark.read.schema(_MANIFEST).json(f"{base}/manifest/load={load}").collect():
            found[row.layer].setdefault(row.bucket, []).append(row.load)
    return found


def folders(base: str, layer: str, held: dict[int, list[int]], touched: list[int] | None = None) -> list[str]:
    buckets = held if touched is None else [b for b in touched if b in held]
    return [f"{base}/{layer}/load={load}/bucket={b}" for b in buckets for load in sorted(held[b])]


def _read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(df: DataFrame, base: str, layer: str, load: int) -> list[int]:
    """Write by bucket; returns the buckets that have rows."""
    path = f"{base}/{layer}/load={load}"
    df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    try:
        return sorted(row.bucket for row in df.sparkSession.read.parquet(path).select("bucket").distinct().collect())
    except AnalysisException:  # nothing was written
        return []


def take_load(
    spark: SparkSession, new_files: str, base: str, load: int, limit_unit: str = "raw", buckets: int = BUCKETS,
    compact_every: int = COMPACT_EVERY, **cleaning_options,
) -> dict[str, list[int]]:
    """Take the event files below ``new_files`` as load number ``load`` (0, 1, 2, …); returns the buckets touched by layer."""
    held = read_manifest(spark, base, load - 1)
    with Scratch(spark) as scratch:
        first = scratch.keep(cleaning.dedup_events(readers.read_raw_events(spark, new_files)), "first_copies")
        id_buckets = [row[0] for row in first.select(bucket_of("event_id", buckets)).distinct().collect()]
        known = _read(spark, folders(base, "ids", held["ids"], id_buckets), "event_id string")
        fresh = scratch.keep(first.join(known, first.event_id.eqNullSafe(known.event_id), "left_anti"), "fresh")
        ids = fresh.select("event_id", bucket_of("event_id", buckets).alias("bucket"))
        touched = {"ids": _write(ids, base, "ids", load)}

        events = medallion.clean(fresh, deduplicated=True, **cleaning_options)
        events.write.mode("overwrite").parquet(f"{base}/silver/load={load}")
        events = spark.read.schema(events.schema).parquet(f"{base}/silver/load={load}")
        parts = partials.trip_partials(events, limit_unit)
        schema = parts.schema
        touched["partials"] = _write(parts.withColumn("bucket", bucket_of("driver_id", buckets)), base, "partials", load)

        now = {layer: {b: list(loads) for b, loads in by.items()} for layer, by in held.items()}
        for layer in ("ids", "partials"):
            for b in touched[layer]:
                now[layer].setdefault(b, []).append(load)
        rows = _read(spark, folders(base, "partials", now["partials"], touched["partials"]), schema)
        merged = scratch.keep(partials.merge_partials(rows), "merged")
        gold = partials.features_of(merged).withColumn("bucket", bucket_of("driver_id", buckets))
        touched["gold"] = _write(gold, base, "gold", load)
        now["gold"].update({b: [load] for b in touched["gold"]})

        # folders of a bucket become one, under the number of this load; later reads of the old ones end with this load
        full = [b for b in touched["partials"] if len(now["partials"][b]) >= compact_every]
        if full:
            rows = merged.withColumn("bucket", bucket_of("driver_id", buckets))
            _replace(rows, base, "partials", load, full)
            now["partials"].update({b: [load] for b in full})
        full = [b for b in touched["ids"] if len(now["ids"][b]) >= compact_every]
        if full:
            whole = scratch.keep(_read(spark, folders(base, "ids", now["ids"], full), "event_id string"), "all_ids")
            _replace(whole.withColumn("bucket", bucket_of("event_id", buckets)), base, "ids", load, full)
            now["ids"].update({b: [load] for b in full})

    rows = [(layer, load_, b) for layer, by in now.items() for b, loads in by.items() for load_ in loads]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{base}/manifest/load={load}")
    return touched


def _replace(df: DataFrame, base: str, layer: str, load: int, only: list[int]) -> None:
    """Put rows in the place of this load's folders of the buckets ``only``."""
    writer = df.where(F.col("bucket").isin(only)).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{base}/{layer}/load={load}")


def _layer(spark: SparkSession, base: str, load: int, layer: str, schema) -> DataFrame:
    return _read(spark, folders(base, layer, read_manifest(spark, base, load)[layer]), schema)


def read_gold(spark: SparkSession, base: str, load: int) -> DataFrame:
    """The driver features after ``load``."""
    return _layer(spark, base, load, "gold", partials.DRIVER_FEATURES)


def read_trips(spark: SparkSession, base: str, load: int) -> DataFrame:
    """The trip summary after ``load``."""
    schema = spark.read.parquet(f"{base}/partials/load={load}").drop("bucket").schema
    return partials.trips_of(partials.merge_partials(_layer(spark, base, load, "partials", schema)))
