"""SimHash near-duplicates: fingerprints, links within a bit distance, and their connected components.

Candidates come from pigeonring filtering. A fingerprint is a ring of ``max_bits + 1`` segments. If two differ in at
most ``max_bits`` bits, then somewhere on the ring a chain starts whose first l segments differ in at most
l * max_bits / (max_bits + 1) bits, rounded down, so l - 1, for every l. Two segments of such a chain make the join
key: the first is equal, the second differs in one bit at most. One side brings its key as it is, the other with
every allowed change, and the join condition requires the rest of the chain and then the full distance. Each pair
appears at the first chain start that holds, so once.

Equal fingerprints are one vertex from the start, so thousands of copies cost one row; what is joined are distinct
fingerprints. Components come from alternating star steps over written tables: groups are folded to minima, never
collected. Joins on fingerprints ask for a merge: Spark takes a generated side for as small as the table it is made
from, and would send all keys of all fingerprints through the driver.

Defined cases: null or blank texts have fingerprint zero and link like any other; texts of fewer words than a shingle
are one shingle; repeated doc_ids get the same component where their fingerprints link; a null doc_id counts for no
minimum, and a component of nothing else has a null id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from milemark.llm.batches import Scratch, text_slices

BITS = 64
SEED = 42


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the hashes of all shingles of words, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[shingle - 1 :].tolist() or [len(line)]
    hashes = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(begins, ends)), np.uint64, len(ends))
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``fingerprint`` (64 bits as a long) and ``text_hash``."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = [text_fingerprint(text, shingle) for text in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(found, pa.int64()), part.column("_hash")], names)

    names = [id_col, "fingerprint", "text_hash"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema.add("fingerprint", T.LongType()).add("text_hash", T.LongType())
    columns = F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_hash")
    return docs.select(*columns).mapInArrow(run, schema)


def _segments(fingerprint: Column, widths: list[int]) -> list[Column]:
    out, shift = [], 0
    for width in widths:
        out.append(F.shiftrightunsigned(fingerprint, shift).bitwiseAND(F.lit((1 << width) - 1)))
        shift += width
    return out


def _chains(difference: Column, widths: list[int]) -> list[Column]:
    """By chain start: whether all prefixes around the ring keep their budgets."""
    counts = [F.bit_count(s) for s in _segments(difference, widths)]
    starts = []
    for i in range(len(widths)):
        held, total = F.lit(True), F.lit(0)
        for step in range(len(widths)):
            total = total + counts[(i + step) % len(widths)]
            held = held & (total <= step)
        starts.append(held)
    return starts


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (low, high) of the distinct longs in column ``fingerprint`` that differ in 1 to ``max_bits`` bits."""
    if not 1 <= max_bits <= 7:
        raise ValueError("max_bits from 1 to 7: keys of two segments must stay selective")
    m = max_bits + 1
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    segment = _segments(F.col("fingerprint"), widths)

    def key(i: int, change: int = 0) -> Column:
        """Chain start, and its first segment with the second one as changed."""
        second = segment[(i + 1) % m].bitwiseXOR(F.lit(change).cast("long"))
        both = F.shiftleft(segment[i], widths[(i + 1) % m]).bitwiseOR(second)
        return F.struct(F.lit(i).alias("start"), both.alias("key"))

    def keyed(side: str, keys: list[Column]) -> DataFrame:
        rows = distinct.select(F.col("fingerprint").alias(side), F.explode(F.array(*keys)).alias("k"))
        return rows.select(side, F.col("k.start").alias(f"{side}_start"), F.col("k.key").alias(f"{side}_key"))

    index = keyed("low", [key(i) for i in range(m)])
    probes = keyed("high", [key(i, c) for i in range(m) for c in [0, *(1 << b for b in range(widths[(i + 1) % m]))]])
    chains = _chains(F.col("low").bitwiseXOR(F.col("high")), widths)
    first = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(chains)])
    same = (F.col("low_start") == F.col("high_start")) & (F.col("low_key") == F.col("high_key"))
    probes = probes.hint("merge")
    return index.join(probes, same & (F.col("low") < F.col("high")) & (first == F.col("low_start"))).select("low", "high")


def components(edges: DataFrame, scratch: Scratch, low: str = "low", high: str = "high") -> DataFrame:
    """Vertices of the edges (longs) as ``node`` and the smallest vertex they reach as ``root``.

    Alternating star steps: every vertex hands its smallest neighbour to its larger ones, then to all its smaller
    ones, until the edges stay as they are; the rounds grow with the logarithm of the longest path.
    """
    now = scratch.keep(edges.select(F.greatest(low, high).alias("u"), F.least(low, high).alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.keep(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select("u", "v", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
        after = scratch.keep(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        scratch.drop(large)
        now = after
        if seen == state:
            break
        state = seen
    stars = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by row; and by fingerprint the ``best`` row of its component (id before no id, smallest id,
    smallest text hash)."""
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    row = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), "text_hash")
    distinct = scratch.keep(prints.groupBy("fingerprint").agg(F.min(row).alias("best")), "distinct")
    roots = scratch.keep(components(links(distinct, max_bits), scratch), "roots")
    rooted = distinct.join(roots.hint("merge"), distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "best", F.coalesce("root", "fingerprint").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("best").alias("best"))
    return prints, rooted.select("fingerprint", "root").join(best.hint("merge"), "root").select("fingerprint", "root", "best")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id column, ``fingerprint`` (long) and ``component_id``, the smallest id that is
    reachable over links of at most ``max_bits`` differing bits."""
    prints, members = _grouped(docs, shingle, max_bits, id_col, text_col)
    return prints.join(members.hint("merge"), "fingerprint").select(id_col, "fingerprint", F.col("best.id").alias("component_id"))


def one_of_each(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of its repeats the smallest text hash, and one of
    equal rows. A row without an id stays only where its component holds no id at all."""
    _, members = _grouped(docs, shingle, max_bits, id_col, text_col)
    best = members.select("best.id", "best.text_hash").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_hash"))
    same = rows["own_id"].eqNullSafe(best["id"]) & (rows["own_hash"] == best["text_hash"])
    kept = rows.join(best.hint("merge"), same, "left_semi")
    # equal ids with equal texts: the first copy by all its columns
    order = Window.partitionBy("own_id", "own_hash").orderBy("row")
    return kept.withColumn("copy", F.row_number().over(order)).where("copy = 1").select("row.*")
