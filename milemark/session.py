"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings of the sessions made here, for one machine; a session made elsewhere keeps its own.
LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce less eagerly: much of the work (parsing, hashing, opening files) is heavy per byte
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "milemark") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Hours and days are counted in UTC: the one setting results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_folder:
        _own_folder[context.applicationId] = tempfile.mkdtemp(prefix="milemark-")
    return _own_folder[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def store(df: DataFrame, name: str, max_rows: int = 0) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back. Files hold ``max_rows`` rows at most; 0 sets
    no limit."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", max_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytecodes of a method beyond which the JVM never compiles it; Spark generates methods of up to 65,535.
COMPILED_METHOD_LIMIT = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_steps(spark: SparkSession):
    """For the time of an action, steps whose common method the JVM would not compile run one by one, in methods that it
    does. Results are the same; the session gets its own limit back."""
    own = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, str(min(int(own), COMPILED_METHOD_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, own)


class Scratch:
    """Tables written to the shared folder for the time of a job: ``with Scratch(spark) as scratch`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
