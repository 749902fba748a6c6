"""Reading the layers of the lake and the small files around it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.schemas import EVENTS, MODEL_SUMMARY, REGISTRY


def read_raw_events(spark: SparkSession, path: str, schema: T.StructType = EVENTS) -> DataFrame:
    """All raw event files below ``path``, with the contract instead of inferred types."""
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """One or more Parquet tables or partitioned datasets as one; partition columns come back.

    With the contract as ``schema`` they come back in its types (``event_date`` is a string there).
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_tree(
    spark: SparkSession, path: str, name_glob: str = "*.parquet", folder_glob: str | None = None
) -> DataFrame:
    """Every matching file at any depth below ``path``, folder names notwithstanding; or the files below the folders
    that match ``folder_glob``, such as ``event_date=2024-*``, whose partition columns come back."""
    if folder_glob is not None:
        reader = spark.read.option("basePath", path).option("pathGlobFilter", name_glob)
        return reader.parquet(f"{path}/{folder_glob}")
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob).parquet(path)
    )


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters: the known fields in their types, the reason, and the event as it came (``_original``)."""
    extra = [T.StructField("_dlq_reason", T.StringType()), T.StructField("_original", T.StringType())]
    schema = T.StructType([*EVENTS.fields, *extra])
    return spark.read.schema(schema).json(path)


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines of a JSON-lines folder."""
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"))


def read_model_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SUMMARY).csv(path, header=True)


def read_registry(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(REGISTRY).json(path, multiLine=multi_line)


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Metric or manifest files: one JSON document per file."""
    return spark.read.json(path, multiLine=True)


def optional(reader, *args, **kwargs) -> DataFrame | None:
    """``None`` instead of an error where the input does not exist."""
    try:
        return reader(*args, **kwargs)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def file_inventory(spark: SparkSession, path: str, name_glob: str = "*") -> DataFrame:
    """(filename, size_kb, modified) of the files below ``path``, newest first."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("filename"),
            (F.col("length") / 1024).alias("size_kb"),
            F.col("modificationTime").alias("modified"),
        )
    )
    return files.orderBy(F.col("modified").desc(), "filename")


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """One row: files, total size, latest file."""
    return inventory.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size_kb").alias("total_kb"),
        F.max_by("filename", F.struct("modified", "filename")).alias("latest_file"),
    )
