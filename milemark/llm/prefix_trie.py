"""The trie of conversation prefixes, cut at half depth again and again (van Emde Boas order).

A turn's digest covers role and text; texts themselves are never shuffled. The sequence of a conversation is cut into
chunks of ``chunk`` turns, the smallest tries, which array functions handle in a row. Above them ranges of 2, 4, 8 …
chunks are cut at half depth:

* Naming: digests of aligned blocks are put together upwards, two halves at a time. Then all ranges of one size are cut
  at once, the largest first: the name of a range's start and the block of its upper half name the cut prefix, which
  is the start of the lower half. Both halves are named by the same step at the next size, in parallel. A prefix and
  its name are one: equal prefixes get equal names whatever conversation they come from.
* Totals: every small trie sums its own nodes first. Then, the smallest ranges first, the totals of all lower forests
  are summed by the cut node they hang from and grafted to it and to its ancestors in the upper trie.

So there are twice log2(depth / chunk) rounds, whatever the depth of the longest conversation; a round's rows shrink by
half with the size for naming, and totals hand on one row for each cut node and ancestor.

A long conversation is no hot task: its turns are ordered by ranges of (conversation, turn, digest) with one offset for
each range, and everything after goes by (conversation, chunk). A prefix that very many conversations share is counted
before the shuffle; the ids of the conversations that end there are made into strings by ranges of ids and digested in
order, as a stream.

Defined cases: null role or text is empty; rows without a conversation belong to none; null turns come first, equal
turns are ordered by their digest; repeated rows are turns of their own; a conversation without turns ends at the root;
no rows give no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milemark.llm.batches import Scratch

#: Turns in the smallest tries.
CHUNK = 8
#: Conversation ids in one string at most.
ID_SLICE = 4096


def _named(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def place_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, place, digest, chars): places count from 1 in the order of turn and digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest(role, text).alias("digest"), F.char_length(text).cast("long").alias("chars")
    )
    # equal rows are one row with a number, so that no turn of a conversation is too frequent for one range
    rows = rows.groupBy("conv", "turn", "digest").agg(F.count("*").alias("copies"), F.max("chars").alias("chars"))
    ranged = rows.repartitionByRange("conv", "turn", "digest").withColumn("range", F.spark_partition_id())
    ranged = scratch.keep(ranged, "turns")
    inside = Window.partitionBy("conv", "range").orderBy(F.asc_nulls_first("turn"), "digest").rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("conv", "range").agg(F.sum("copies").alias("n"))
    # conversations within one range need no offset
    offsets = offsets.withColumn("offset", F.sum("n").over(earlier)).where("offset > 0").drop("n")
    placed = own.join(offsets, ["conv", "range"], "left")
    first = F.col("ahead") + F.coalesce("offset", F.lit(0)) + 1
    place = F.explode(F.sequence(first, first + F.col("copies") - 1))
    return placed.select("conv", place.alias("place"), "digest", "chars")


def share_heads(placed: DataFrame, group: int, most: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation c on the head of conversation c - c % ``group``: its first crc32(c) % ``most`` turns,
    or all if there are fewer, then c's own turns after as many. Returns the conversations (conv) and the turns."""
    convs = scratch.keep(placed.groupBy("conv").agg(F.count("*").alias("n")), "conversations")
    taken = (F.crc32(F.col("conv").cast("string")) % most).alias("h")
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), taken)
    sizes = convs.select(F.col("conv").alias("base"), F.least("n", F.lit(most)).alias("has"))
    wanted = wanted.join(sizes, "base", "left").withColumn("has", F.least("h", F.coalesce("has", F.lit(0))))
    heads = placed.where(F.col("place") < most).withColumnRenamed("conv", "base")
    lent = wanted.where("h > 0").join(heads, "base").where("place <= h").select("conv", "place", "digest", "chars")
    own = placed.where(F.col("place") > taken).join(wanted.where("has < h").select("conv", "h", "has"), "conv", "left")
    kept = F.coalesce("has", F.crc32(F.col("conv").cast("string")) % most)
    own = own.select("conv", (F.col("place") - F.crc32(F.col("conv").cast("string")) % most + kept).alias("place"), "digest", "chars")
    return convs.select("conv"), lent.unionByName(own)


def cut_chunks(turns: DataFrame, chunk: int) -> DataFrame:
    """(conv, k, folds, chars): chunk k of a conversation, with the digest of each of its beginnings."""
    k = F.expr(f"(place - 1) div {chunk}")
    rows = turns.groupBy("conv", k.alias("k")).agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns"))
    first = F.array(_named(F.col("turns")[0].digest))
    rest = F.slice("turns", 2, F.size("turns"))
    folds = F.aggregate(rest, first, lambda a, t: F.concat(a, F.array(_named(F.element_at(a, -1), t.digest))))
    return rows.select("conv", "k", folds.alias("folds"), F.col("turns.chars").alias("chars"))


def name_starts(chunks: DataFrame, chunk: int, levels: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv, k, start) and (conv, k, entry) of the chunks behind full ones: two names of the prefix before chunk k, as the
    start of what follows, and as the last node of chunk k - 1."""
    blocks = [chunks.where(F.size("folds") == chunk).select("conv", F.col("k").alias("at"), F.element_at("folds", -1).alias("block"))]
    blocks[0] = scratch.keep(blocks[0], "blocks")
    for level in range(1, levels):
        halves = blocks[-1].groupBy("conv", F.expr("at div 2").alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("block"))).alias("a"), F.max(F.when(F.col("at") % 2 == 1, F.col("block"))).alias("b")
        )
        blocks.append(scratch.keep(halves.dropna().select("conv", "at", _named("a", "b").alias("block")), "blocks"))
    starts = blocks[0].where("at = 0").select("conv", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("start"))
    for level in reversed(range(levels)):
        upper = starts.select("conv", (F.col("at") * 2).alias("at"), "start")
        lower = upper.join(blocks[level], ["conv", "at"]).select("conv", (F.col("at") + 1).alias("at"), _named("start", "block").alias("start"))
        starts = scratch.keep(upper.unionByName(lower), "starts")
    ends = starts.join(blocks[0], ["conv", "at"]).select("conv", (F.col("at") + 1).alias("k"), _named("start", "block").alias("entry"))
    return starts.where("at > 0").withColumnRenamed("at", "k"), ends


def name_chunks(chunks: DataFrame, chunk: int, levels: int, scratch: Scratch) -> DataFrame:
    """(conv, k, entry, names, chars): the names of the nodes along each chunk, and of the one before it."""
    if levels:
        starts, entries = name_starts(chunks, chunk, levels, scratch)
        chunks = chunks.join(starts, ["conv", "k"], "left").join(entries, ["conv", "k"], "left")
    else:
        chunks = chunks.select("*", F.lit(b"").alias("start"), F.lit(b"").alias("entry"))
    start = F.coalesce("start", F.lit(b""))
    names = F.transform("folds", lambda f: _named(start, f))
    return scratch.keep(chunks.select("conv", "k", F.coalesce("entry", F.lit(b"")).alias("entry"), names.alias("names"), "chars"), "named")


def build_nodes(convs: DataFrame, named: DataFrame, chunk: int, scratch: Scratch) -> DataFrame:
    """(name, parent, depth, conv_id, n_convs, chars, n_children) of every node but the root."""
    parents = F.concat(F.array("entry"), F.slice("names", 1, F.size("names") - 1))
    zipped = F.arrays_zip(F.col("names").alias("name"), parents.alias("parent"), F.col("chars").alias("chars"))
    along = named.select("conv", "k", F.posexplode(zipped).alias("i", "node"))
    along = along.select("conv", "node.*", (F.col("k") * chunk + F.col("i") + 1).alias("depth"))
    nodes = along.groupBy("name").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
    )
    nodes = scratch.keep(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    return scratch.keep(nodes.join(children, "name", "left").fillna(0, ["n_children"]), "counted")


def subtree_totals(nodes: DataFrame, named: DataFrame, chunk: int, levels: int, scratch: Scratch) -> DataFrame:
    """(name, n_leaves, saved_tokens) over the subtree of every node but the root."""
    k = F.expr(f"(depth - 1) div {chunk}")
    own = F.struct(
        ((F.col("depth") - 1) % chunk).cast("int").alias("i"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    # a node is counted where the smallest of its conversations passes; what that conversation shares above is not its own
    owned = nodes.groupBy(F.col("conv_id").alias("conv"), k.alias("k")).agg(F.collect_list(own).alias("own"))
    rows = named.select("conv", "k", "entry", "names").join(owned, ["conv", "k"])

    def below(field: str):
        return F.transform(
            F.sequence(F.lit(0), F.size("names") - 1),
            lambda i: F.aggregate(F.filter("own", lambda x: x.i >= i), F.lit(0).cast("long"), lambda a, x: a + x[field]),
        )

    zipped = F.arrays_zip(F.col("names").alias("name"), below("leaf").alias("leaf"), below("saved").alias("saved"))
    rows = rows.select("conv", "k", "entry", F.posexplode(zipped).alias("i", "node"))
    parts = [scratch.keep(rows.select("conv", "k", "entry", "i", "node.*"), "totals")]
    for level in range(levels):
        half = 1 << level
        # the lower forests of all ranges of this size, by the node that they hang from
        tops = reduce(DataFrame.unionByName, parts).where((F.col("i") == 0) & (F.col("k") % (2 * half) == half))
        cut = tops.groupBy("entry", "k").agg(F.min("conv").alias("conv"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        spread = cut.select("conv", "leaf", "saved", F.explode(F.sequence(F.col("k") - half, F.col("k") - 1)).alias("k"))
        found = spread.join(named.select("conv", "k", "entry", "names"), ["conv", "k"])
        found = found.select("conv", "k", "entry", F.posexplode("names").alias("i", "name"), "leaf", "saved")
        parts.append(scratch.keep(found, "totals"))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy("name").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def digest_ends(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of (name, conv): decimal ids in rising order, joined by commas. Ids are put together by ranges
    of ids before they meet, and digested one range after the other."""
    cut = ends.groupBy("name", F.floor(F.col("conv") / ID_SLICE).alias("part"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    parts = cut.agg(ids.alias("ids")).repartition("name").sortWithinPartitions("name", "part")

    def run(batches):
        name, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if key != name or state is None:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows(done)
        if state is not None:
            yield rows([(name, state.hexdigest())])

    def rows(done):
        columns = [pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["name", "ends_sha256"])

    return parts.mapInArrow(run, "name binary, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, chunk: int = CHUNK, scratch: Scratch | None = None) -> DataFrame:
    """One row for each node of the trie of the conversations (conv) with turns (conv, place, digest, chars)."""
    scratch = scratch or Scratch(convs.sparkSession)
    chunks = scratch.keep(cut_chunks(turns, chunk), "chunks")
    deepest = chunks.agg(F.max("k")).first()[0] or 0
    levels = deepest.bit_length()
    named = name_chunks(chunks, chunk, levels, scratch)
    nodes = build_nodes(convs, named, chunk, scratch)
    totals = subtree_totals(nodes, named, chunk, levels, scratch)

    last = named.groupBy("conv").agg(F.max_by(F.element_at("names", -1), "k").alias("name"))
    ends = convs.join(last, "conv", "left").select("conv", F.coalesce("name", F.lit(b"")).alias("name"))
    top = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    # the root's forests: everything
    all_nodes = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.count_if(F.col("n_children") == 0).alias("leaves"),
        F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("chars")), F.lit(0)).alias("saved_tokens"),
    ).first()
    root = top.where("n_convs > 0").select(
        F.lit(b"").alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(all_nodes.n_children).cast("long").alias("n_children"), F.lit(max(all_nodes.leaves, 1)).cast("long").alias("n_leaves"),
        F.lit(all_nodes.saved_tokens).cast("long").alias("saved_tokens"),
    )
    whole = nodes.drop("chars").join(totals, "name").unionByName(root)
    whole = scratch.keep(whole.join(digest_ends(ends), "name", "left"), "whole")
    parents = whole.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


def prefix_trie(conversations: DataFrame, group: int = 100, most: int = 6, chunk: int = CHUNK) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), each rebuilt on the head of its group's first one."""
    scratch = Scratch(conversations.sparkSession)
    placed = scratch.keep(place_turns(conversations, scratch), "placed")
    convs, turns = share_heads(placed, group, most, scratch)
    return trie(convs, turns, chunk, scratch)
