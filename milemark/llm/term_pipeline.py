"""Ranked lexical search: query bundles travel through the owners of their terms.

One pass over the documents makes an inverted index. Documents are cut into blocks of at most ``BLOCK`` rows; a list
holds the places and frequencies of one term in one block, and each block has one more row with its documents' ids and
lengths. Only terms that some query may have are indexed: the tasks get a bitmap of the queries' terms, of fixed size,
and a join removes what it lets through by chance.

Terms belong to owner stages by their document frequency, the rarest first. A bundle is a query in one block of
documents, with a sparse accumulator of (place, score). At each stage the bundles of a block are cogrouped with the
lists that the stage owns there, and integer contributions are added; then they travel on. After the last stage each
bundle hands in its best documents and the best of all are selected.

Between stages every query learns a score that its last result reaches at least, the ``top``-th best so far. A document
that cannot reach it with all remaining terms at their most leaves the bundle, and no new one enters where even all of
them would not do; equal scores stay. So results are exact, and bundles do not grow with frequent words.

A hot term is no hot task: its lists are dealt by block. Queries are dealt into buckets of about ``BUCKET``, so a group
holds at most a bucket's queries and one block's documents. The queries' routes are broadcast only up to
``BROADCAST_ROUTES`` rows, and joined by shuffle beyond.

Defined cases: null texts have no terms and are no documents; queries without a term, or whose terms do not occur, get
no rows; queries of equal id (null is an id) are one query with the terms of all; repeated rows are documents of their
own; among equal scores null ids come first; no documents or no queries give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.llm.batches import Scratch, text_slices

#: Documents in a block; places in it count from 0.
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
#: Queries in a bucket, on average.
BUCKET = 128
#: Bits of the map of the queries' terms.
MAP_BITS = 1 << 24
#: Rows up to which the queries' routes are broadcast.
BROADCAST_ROUTES = 200_000
#: Terms whose bit a worker remembers.
MEMORY = 200_000
#: Ends of the owner stages, as shares of the documents that hold a term.
SHARES = (0.001, 0.02, 0.2)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Every ASCII byte but digits and letters becomes a blank, A-Z are lower-cased, others stay.
_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()

INDEX = "block long, term string, slots array<int>, tfs array<int>, ids array<{}>, lengths array<long>"
BUNDLE = "bucket long, block long, item long, slots array<int>, scores array<long>, best array<long>"


def split_terms(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    return (text or "").encode().translate(_BYTES).split()


def query_terms(text: Column) -> Column:
    """The distinct terms of a text, as a column."""
    return F.array_distinct(F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS, -1), ""))


def term_map(terms: DataFrame) -> list[tuple[int, bytes]]:
    """The queries' terms as bitmaps of 32,768 bits; ``MAP_BITS`` in all, however many terms there are."""
    place = F.crc32(F.col("term").cast("binary")) % MAP_BITS + 1
    parts = terms.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    return [(row.part - 1, bytes(row.bits)) for row in parts.collect()]


class _Wanted(dict):
    """Whether the map has a term's bit; remembers up to ``MEMORY`` answers."""

    def __init__(self, parts: list[tuple[int, bytes]]):
        super().__init__()
        self.parts = dict(parts)

    def __missing__(self, term: bytes) -> bool:
        part, bit = divmod(zlib.crc32(term) % MAP_BITS, 32_768)
        held = self.parts.get(part)
        answer = held is not None and bool(held[bit >> 3] >> (bit & 7) & 1)
        if len(self) >= MEMORY:
            self.clear()
        self[term] = answer
        return answer


def _lists(values: list[list], kind: pa.DataType) -> pa.ListArray:
    return pa.array(values, pa.list_(kind))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Lists (block, term, slots, tfs) of the documents (id, text), and for each block a row without a term that has the
    ids and lengths of its documents by place; no shuffle, since a block lies in one partition."""
    parts = docs.sparkSession.sparkContext.broadcast(term_map(terms))
    kind = docs.schema["id"].dataType
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())

    def run(batches):
        wanted = _Wanted(parts.value)
        block, ids, lengths, lists = None, [], [], {}

        def rows():
            names = list(lists)
            slots, tfs = ([lists[t][k] for t in names] for k in (0, 1))
            n = len(names)
            last = pa.list_(pa.concat_arrays(ids).type if ids else pa.int64())
            whole = pa.concat_arrays(ids) if ids else pa.array([], last.value_type)
            own = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(whole)], pa.int32()), whole)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + 1), pa.int64()), pa.array([t.decode() for t in names] + [None], pa.string()),
                    _lists([*slots, []], pa.int32()), _lists([*tfs, []], pa.int32()), own, _lists([[]] * n + [lengths], pa.int64()),
                ],
                ["block", "term", "slots", "tfs", "ids", "lengths"],
            )

        for batch in batches:
            for part in text_slices(batch):
                keep = []
                places = part.column("_row").to_pylist()
                pending = part.column("id")
                begin = 0
                for i, (row, text) in enumerate(zip(places, part.column("text").to_pylist())):
                    if block is not None and row >> BLOCK_BITS != block:
                        ids.append(pending.slice(begin, i - begin).take(pa.array(keep, pa.int64())))
                        if lengths:
                            yield rows()
                        ids, lengths, lists, keep, begin = [], [], {}, [], i
                    block = row >> BLOCK_BITS
                    found = split_terms(text)
                    if not found:
                        continue
                    slot = len(lengths)
                    keep.append(i - begin)
                    lengths.append(len(found))
                    for term, tf in Counter(found).items():
                        if wanted[term]:
                            held = lists.setdefault(term, ([], []))
                            held[0].append(slot)
                            held[1].append(tf)
                ids.append(pending.slice(begin).take(pa.array(keep, pa.int64())))
        if lengths:
            yield rows()

    return numbered.mapInArrow(run, INDEX.format(kind.simpleString()))


def weigh(lists: DataFrame, item_terms: DataFrame, n_docs: int) -> DataFrame:
    """(term, weight, most, stage) of the queries' terms that occur; ``most`` bounds what one document gets from it."""
    counted = lists.join(item_terms.select("term").distinct(), "term", "left_semi").groupBy("term")
    counted = counted.agg(F.sum(F.size("slots")).alias("df"), F.max(F.array_max("tfs")).cast("long").alias("tf"))
    weight = F.floor(1000.0 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    stage = sum((F.col("df") > share * n_docs).cast("int") for share in SHARES)
    # no document's m is below 50
    most = F.expr("(1000000000 * tf) div (1000 * tf + 20 * 50)")
    return counted.select("term", weight.alias("weight"), stage.alias("stage"), most.alias("most")).withColumn("most", F.col("weight") * F.col("most"))


def visit(n_docs: int, n_terms: int, top: int, last: bool, id_type: pa.DataType):
    """The work of one stage on the bundles and lists of one block and bucket."""

    def add(key, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        # key columns come first: bucket, block
        own = lists.filter(pc.is_null(lists.column("weight")))
        lengths = own.column("lengths").combine_chunks().flatten().to_numpy()
        m = 100 - 50 + (50 * lengths * n_docs) // n_terms
        lists = lists.filter(pc.is_valid(lists.column("weight")))
        routes = lists.column("items").combine_chunks().flatten()
        of_routes = [routes.field(k).to_numpy() for k in range(3)] if len(routes) else [np.zeros(0, np.int64)] * 3
        items = np.unique(np.r_[bundles.column("item").to_numpy(), of_routes[0]])
        floor_in, floor_out = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        for numbers, before, after in ([bundles.column(c).to_numpy() for c in ("item", "floor_in", "floor_out")], of_routes):
            at = np.searchsorted(items, numbers)
            floor_in[at], floor_out[at] = before, after
        total = np.zeros((len(items), len(m)), np.int64)
        slots, scores = (bundles.column(c).combine_chunks() for c in ("slots", "scores"))
        if len(bundles):
            rows = np.repeat(np.searchsorted(items, bundles.column("item").to_numpy()), pc.list_value_length(slots).to_numpy())
            places, had = slots.flatten().to_numpy(), scores.flatten().to_numpy()
            stays = had >= floor_in[rows]
            total[rows[stays], places[stays]] = had[stays]
        opened = floor_in <= 0
        known = total > 0
        slots, tfs, weights = (lists.column(c).combine_chunks() for c in ("slots", "tfs", "weight"))
        routes = lists.column("items").combine_chunks()
        for i in range(len(lists)):
            places, tf = slots[i].values.to_numpy(), tfs[i].values.to_numpy().astype(np.int64)
            gain = weights[i].as_py() * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[places]))
            at = np.searchsorted(items, routes[i].values.field(0).to_numpy())
            free, shut = at[opened[at]], at[~opened[at]]
            if len(free):
                total[np.ix_(free, places)] += gain
            if len(shut):
                here = np.ix_(shut, places)
                total[here] += np.where(known[here], gain, 0)
        stays = (total > 0) & (total >= floor_out[:, None])
        ids = own.column("ids").combine_chunks().flatten() if last else None
        out = []
        for row in np.flatnonzero(stays.any(axis=1)):
            places = np.flatnonzero(stays[row])
            got = total[row, places]
            if last:
                # by falling score, then rising id
                named = pa.table({"score": got, "id": ids.take(pa.array(places))})
                order = [("score", "descending"), ("id", "ascending")]
                best = pc.sort_indices(named, sort_keys=order, null_placement="at_start")[:top]
                out.append((int(items[row]), named.take(best)))
            else:
                best = np.sort(got)[::-1][:top]
                out.append((int(items[row]), places, got, best))
        if last:
            parts = [t.append_column("item", pa.array([item] * len(t), pa.int64())) for item, t in out]
            whole = pa.concat_tables(parts) if parts else pa.table({"score": pa.array([], pa.int64()), "id": pa.array([], id_type), "item": pa.array([], pa.int64())})
            return whole.select(["item", "id", "score"])
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()), "block": pa.array([key[1].as_py()] * len(out), pa.int64()),
                "item": pa.array([x[0] for x in out], pa.int64()), "slots": _lists([x[1] for x in out], pa.int32()),
                "scores": _lists([x[2] for x in out], pa.int64()), "best": _lists([x[3] for x in out], pa.int64()),
            }
        )

    return add


def search(
    docs: DataFrame, queries: DataFrame, top: int = 50, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item column, rank, id column, score): the ``top`` documents with the highest scores above 0 for each query."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(item_col, queries.schema[item_col].dataType), T.StructField("rank", T.IntegerType())])
    schema.add(id_col, id_type).add("score", T.LongType())

    cut = queries.select(F.col(item_col).alias("item_id"), F.explode(query_terms(F.col(text_col))).alias("term")).distinct()
    cut = scratch.keep(cut, "query_terms")
    index = scratch.keep(build_index(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), cut), "index")
    blocks, lists = index.where("term is null"), index.where("term is not null")
    lengths = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = blocks.agg(F.sum(F.size("ids")).alias("n"), F.sum(lengths).alias("l")).first()
    n_queries = cut.select("item_id").distinct().count()
    if not sums.n or not n_queries:
        return spark.createDataFrame([], schema)

    number = F.monotonically_increasing_id()
    buckets = math.ceil(n_queries / BUCKET)
    items = scratch.keep(cut.select("item_id").distinct().withColumn("item", number), "queries")
    items = items.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
    terms = scratch.keep(weigh(lists, cut, sums.n), "terms")
    named = cut.withColumnRenamed("item_id", "q").join(items, F.col("q").eqNullSafe(F.col("item_id"))).join(terms, "term")
    wanted = scratch.keep(named.select("item", "bucket", "term", "weight", "stage", "most"), "wanted")
    size = wanted.count()
    stages = sorted(row.stage for row in wanted.select("stage").distinct().collect())

    bundles, reached = spark.createDataFrame([], BUNDLE), None
    for k, stage in enumerate(stages):
        last = k == len(stages) - 1
        # what a query may still get: from this stage on, and after it
        left = wanted.where(F.col("stage") >= stage).groupBy("item", "bucket").agg(
            F.sum("most").alias("ahead"), F.coalesce(F.sum(F.when(F.col("stage") > stage, F.col("most"))), F.lit(0)).alias("after")
        )
        least = F.lit(0).cast("long")
        if reached is not None:
            left, least = left.join(reached, "item", "left"), F.coalesce("least", F.lit(0))
        state = left.select("item", "bucket", (least - F.col("ahead")).alias("floor_in"), (least - F.col("after")).alias("floor_out"))
        routed = wanted.where(F.col("stage") == stage).join(state, ["item", "bucket"]).groupBy("bucket", "term", "weight")
        routed = routed.agg(F.collect_list(F.struct("item", "floor_in", "floor_out")).alias("items"))
        if size <= BROADCAST_ROUTES:
            state, routed = F.broadcast(state), F.broadcast(routed)
        owned = lists.select("block", "term", "slots", "tfs").join(routed, "term").drop("term")
        own = blocks.select("block", "ids", "lengths", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"))
        owned = owned.unionByName(own, allowMissingColumns=True)
        # queries without terms left keep what they have
        carried = bundles.join(state, ["item", "bucket"], "left").fillna(0, ["floor_in", "floor_out"])
        if reached is not None and not last:
            carried = carried.drop("best")
        work = visit(sums.n, sums.l, top, last, _arrow_type(id_type))
        pair = carried.groupBy("bucket", "block").cogroup(owned.groupBy("bucket", "block"))
        out = pair.applyInArrow(work, f"item long, id {id_type.simpleString()}, score long" if last else BUNDLE)
        bundles = scratch.keep(out, f"bundles{k}")
        if not last:
            scores = bundles.select("item", F.explode("best").alias("score"))
            order = Window.partitionBy("item").orderBy(F.desc("score"))
            nth = scores.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
            reached = nth.where(F.col("place") == top).select("item", F.col("score").alias("least"))

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    best = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(items, "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
