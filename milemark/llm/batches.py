"""Helpers shared by the text operators: Arrow slices of bounded size, and scratch tables that are dropped again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from milemark.session import scratch_path

#: Text bytes that a task looks at in one go; a single longer text is taken alone.
SLICE_BYTES = 4 << 20


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch with at most ``limit`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


class Scratch:
    """Tables in the shared folder (``spark.checkpoint.dir``), each droppable once nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        """Write ``df`` once and read it back; cuts the lineage."""
        path = scratch_path(self.spark, name)
        writer = df.write if partition is None else df.write.partitionBy(partition)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a kept table; only for tables that no lazy plan still needs."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
