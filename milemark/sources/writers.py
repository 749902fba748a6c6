"""Writing the layers of the lake, dead letters, reports and run manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.functions.hashing import config_fingerprint
from milemark.session import compiled_steps

MAX_BRONZE_FILE_ROWS = 50_000
MAX_LETTER_FILE_ROWS = 200_000
PREVIEW_ROWS = 20


def write_bronze(
    events: DataFrame, path: str, max_rows: int = MAX_BRONZE_FILE_ROWS, mode: str = "overwrite"
) -> None:
    """Files of at most ``max_rows`` rows."""
    events.write.mode(mode).option("maxRecordsPerFile", max_rows).parquet(path)


def write_silver_events(
    events: DataFrame, path: str, partition_by: list[str] = ["event_date"], mode: str = "overwrite"
) -> None:
    """Partitioned by day, each file ordered by driver, trip and time.

    Spark splits a day over as many tasks as its size asks for (the rebalance hint), so a busy day is
    no single task. Partitioning by driver as well is possible but makes one small file per driver
    and day; ordering files by driver lets Parquet statistics skip most of them instead.
    """
    order = ["driver_id", "trip_id", "ts"]
    clustered = events.hint("rebalance", *partition_by)
    clustered.sortWithinPartitions(*partition_by, *order).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_trips(trips: DataFrame, path: str, mode: str = "overwrite") -> None:
    trips.write.mode(mode).parquet(path)


def write_gold(
    features: DataFrame, path: str, partition_by: list[str] = [], mode: str = "overwrite"
) -> None:
    """Clustered by driver; partitioned only on request, since a folder per driver holds one row."""
    writer = features.sortWithinPartitions("driver_id").write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_dead_letters(letters: DataFrame, path: str, max_rows: int = MAX_LETTER_FILE_ROWS) -> None:
    """JSON lines: the event's known fields and ``_dlq_reason``. Names and values repeat in every line, so files are
    compressed; one task reads a compressed file, hence its limit of rows. The reasons are a long chain of conditions over
    all columns: in one method with the steps before, they would be interpreted."""
    with compiled_steps(letters.sparkSession):
        letters.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", max_rows).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small report as one CSV file with header."""
    df.coalesce(1).write.mode(mode).csv(path, header=True)


def write_preview(df: DataFrame, path: str, order: list[str], n: int = PREVIEW_ROWS) -> None:
    write_csv(df.orderBy(*order).limit(n), path)


def manifest(
    df: DataFrame, measures: dict[str, Column], parameters: dict | None = None, run_time: str | None = None
) -> DataFrame:
    """One row: measured figures, parameters, their fingerprint and the run time."""
    parameters = parameters or {}
    measured = df.agg(*[c.alias(name) for name, c in measures.items()])
    stamp = F.lit(run_time) if run_time else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return measured.select(
        "*",
        *[F.lit(value).alias(name) for name, value in parameters.items()],
        F.lit(config_fingerprint(parameters)).alias("config_hash"),
        stamp.alias("run_time"),
    )


def append_manifest(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("append").json(path)


def write_avro(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Needs the separate spark-avro package on the cluster."""
    events.write.mode(mode).format("avro").save(path)
