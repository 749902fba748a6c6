"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A key is a line without blanks at its ends and with A-Z lower-cased, held as two 64-bit hashes. A run is a bucketed table
of keys, each bucket one sorted file, with the number of documents that hold each key and the largest of their ids.
``LineRuns.add`` merge-anti-joins a new batch with the runs, bucket by bucket, and writes the keys never seen as a run of
level 0; the counts of the others go into additions beside it. When a level has ``fanout`` runs, they are merged into one
run of the next level, and so are the additions; a single run takes the additions in. A key so lives in one run, and a
batch is compared with few tables, however many came before. A batch is shuffled once, when it is bucketed; runs are
neither shuffled nor sorted again to be joined, and merging them needs no shuffle. At the end all runs and additions are
merged, and the repeated keys are read off the one that results.

Counts are made by one row for each document and key, pre-aggregated before any shuffle; a line that a third of all
documents hold is one row per task. The drop lists come from a join of the documents' keys with the repeated ones,
which Spark may split at a hot key, and return to the documents by id.

Defined cases: null text is the empty text, which is one empty line; a null id is smaller than any other, and such
rows all hold the key as that one document's would; rows that repeat an id count once each, and all of them keep
their lines where that id is the largest; other columns are kept, those named like an output are replaced.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.llm.batches import Scratch
from milemark.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _keys(text: Column, least_chars: int) -> Column:
    """Array of (line number, two hashes) of the lines with long enough keys."""
    lines = F.split(F.translate(text, UPPER, LOWER), "\n", -1)
    lines = F.transform(lines, lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(BLANKS)).alias("key")))
    lines = F.filter(lines, lambda x: F.char_length(x["key"]) >= least_chars)
    hashes = lambda x: (F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit(1), x["key"]).alias("h2"))
    return F.transform(lines, lambda x: F.struct(x["line"].alias("line"), *hashes(x)))


def line_keys(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """By row: ``_id``, ``_text_hash`` (which tells rows of one id apart) and ``_keys``; rows without keys are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text_hash"), _keys(text, least_chars).alias("_keys"))
    return keyed.where(F.size("_keys") > 0)


def counted(keyed: DataFrame) -> DataFrame:
    """By key: documents that hold it and the largest id."""
    held = F.array_distinct(F.transform("_keys", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    rows = keyed.select("_id", F.explode(held).alias("k")).select("_id", "k.h1", "k.h2")
    return rows.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("_id").alias("max_id"))


def _merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """Counts and largest ids of two tables added up, by a merge join of their buckets."""
    same = (one["h1"] == other["h1"]) & (one["h2"] == other["h2"])
    n = F.coalesce(one["n_docs"], F.lit(0)) + F.coalesce(other["n_docs"], F.lit(0))
    return one.join(other.hint("merge"), same, "full_outer").select(
        F.coalesce(one["h1"], other["h1"]).alias("h1"), F.coalesce(one["h2"], other["h2"]).alias("h2"),
        n.alias("n_docs"), F.greatest(one["max_id"], other["max_id"]).alias("max_id"),
    )


class LineRuns:
    """Levelled sorted runs, in the shared folder; all in the same number of buckets (by default that of shuffles)."""

    #: A bucket that is one file counts as sorted.
    ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.scratch, self.fanout = spark, Scratch(spark), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: dict[int, str] = {}
        self.levels: list[list[DataFrame]] = []
        self.additions: list[DataFrame] = []

    def _write(self, keys: DataFrame, name: str) -> DataFrame:
        """A table of one sorted file for each bucket; ``keys`` lie in the buckets already."""
        path = scratch_path(self.spark, name)
        table = os.path.basename(path).replace("-", "_")
        before = self.spark.conf.get(self.ORDERED)
        self.spark.conf.set(self.ORDERED, "true")
        try:
            writer = keys.write.format("parquet").option("path", path)
            writer.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(table)
        finally:
            self.spark.conf.set(self.ORDERED, before)
        out = self.spark.table(table)
        self.names[id(out)], self.scratch.paths[id(out)] = table, path
        return out

    def _forget(self, run: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE {self.names.pop(id(run))}")
        self.scratch.drop(run)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys that no run holds: a merge anti join by run, the largest run first."""
        for run in reversed(self.runs()):
            keys = keys.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Take in the keys of a batch (as from ``counted``)."""
        batch = self._write(keys.repartition(self.buckets, "h1", "h2"), "batch")
        if not self.levels:
            self.levels.append([batch])
            return
        fresh = self._write(self.unseen(batch), "run")
        known = batch.join(fresh.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self.additions.append(self._write(known, "additions"))
        self._forget(batch)
        self.levels[0].append(fresh)
        self._compact()

    def _merge(self, parts: list[DataFrame], name: str) -> DataFrame:
        """One table of all, two at a time: what a full join returns has no buckets until it is written."""
        merged = parts[0]
        for part in parts[1:]:
            both = self._write(_merged(merged, part), name)
            self._forget(merged)
            self._forget(part)
            merged = both
        return merged

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            parts, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            # with no other run left, the additions belong to this one
            if not self.runs():
                parts, self.additions = [*parts, *self.additions], []
            self.levels[level + 1].append(self._merge(parts, "run"))
            level += 1
        if len(self.additions) >= self.fanout:
            self.additions = [self._merge(self.additions, "additions")]

    def drop(self) -> None:
        for part in [*self.runs(), *self.additions]:
            self._forget(part)
        self.levels, self.additions = [], []

    def repeated(self, least_docs: int) -> DataFrame:
        """The keys that ``least_docs`` documents hold or more, over all batches, read off the runs, which become one."""
        parts = [*self.runs(), *self.additions]
        if not parts:
            raise ValueError("no batch was added")
        self.levels[-1], self.additions = [self._merge(parts, "run")], []
        self.levels[:-1] = [[] for _ in self.levels[:-1]]
        return self.levels[-1][0].where(F.col("n_docs") >= least_docs)


def dedup_lines(
    docs: DataFrame, least_docs: int = 3, least_chars: int = 20, batches: int = 4, fanout: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` whose lines with repeated keys are gone from all documents but the one with the largest id; with
    ``n_lines`` (before) and ``n_dropped``. Documents enter the runs in ``batches`` classes of their id's hash."""
    scratch = Scratch(docs.sparkSession)
    batch = F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int")
    keyed = scratch.keep(line_keys(docs, id_col, text_col, least_chars).withColumn("_batch", batch), "line_keys", "_batch")
    runs = LineRuns(docs.sparkSession, fanout)
    for k in range(batches):
        runs.add(counted(keyed.where(F.col("_batch") == k)))
    repeated = scratch.keep(runs.repeated(least_docs), "repeated")
    runs.drop()
    rows = keyed.select("_id", "_text_hash", F.explode("_keys").alias("k")).select("_id", "_text_hash", "k.line", "k.h1", "k.h2")
    hits = rows.join(repeated, ["h1", "h2"]).where(~F.col("_id").eqNullSafe(F.col("max_id")))
    lists = hits.groupBy("_id", "_text_hash").agg(F.collect_set("line").alias("_drop"))
    lists = lists.withColumnsRenamed({"_id": "_drop_id", "_text_hash": "_drop_hash"})
    # lines are cut before the join: behind it, they are a column and not cut again for each line
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    cut = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_text_hash"),
        F.split(text, "\n", -1).alias("_lines"),
    )
    same = cut["_id"].eqNullSafe(lists["_drop_id"]) & (cut["_text_hash"] == lists["_drop_hash"])
    joined = cut.join(lists, same, "left")
    n = F.size("_lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "_drop")
    kept = F.when(F.col("_drop").isNull(), F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    )
    return joined.select(
        *[(kept if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns if c in (*others, text_col)],
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
