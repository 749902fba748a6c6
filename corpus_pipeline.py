"""The corpus pipeline: each stage works on what its predecessor kept; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milemark.llm import byte_bpe, decontamination, line_dedup, simhash, toxicity
from milemark.llm.queries import RANKS, THRESHOLD, toxicity_model
from milemark.llm.registry import query, table
from milemark.session import store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the classifiers learn from ``labels``."""
    return toxicity.drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")), THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the one with the largest id; ``n_chars`` follows the text, where
    lines went."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in twenty or more inside benchmark windows go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and the digests of the ids and of the bytes they decode to."""
    tokens = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(tokens, RANKS).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_level_bpe", encode),
]

#: The classifiers cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
