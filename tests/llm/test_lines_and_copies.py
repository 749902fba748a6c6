"""Line dedup, sharding and SimHash near-duplicates."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from milemark.llm import histogram_shards, line_dedup, simhash
from milemark.llm.batches import Scratch


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2)])
def test_lines_equal_brute_force(messy_rows, messy, batches, fanout):
    rows = line_dedup.dedup_lines(messy, batches=batches, fanout=fanout).collect()
    key = lambda r: (str(r[0]), *r[1:])
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=key)
    expected = brute.line_dedup([r[:2] for r in messy_rows])
    assert got == sorted(expected, key=key)
    assert sum(r[2] for r in expected) > 10


def test_lines_keep_other_columns(messy, clashing, empty):
    kept = line_dedup.dedup_lines(clashing)
    assert [c for c in kept.columns if c not in ("n_lines", "n_dropped")] == [c for c in clashing.columns if c != "n_lines"]
    assert kept.where("row = 'own row' and _drop = 'own _drop'").count() == messy.count()
    assert line_dedup.dedup_lines(empty).count() == 0


def test_runs_hold_each_key_once_and_compact(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    rng = random.Random(3)
    total = Counter()
    for batch in range(7):
        keys = {rng.randint(0, 60) for _ in range(30)}
        total.update(keys)
        runs.add(spark.createDataFrame([(k, -k, 1, 100 * batch + k) for k in keys], "h1 long, h2 long, n_docs long, max_id long"))
        held = [r.h1 for run in runs.runs() for r in run.collect()]
        assert sorted(held) == sorted(set(total)) and len(runs.runs()) <= 3
    got = {r.h1: r.n_docs for r in runs.repeated(3).collect()}
    assert got == {k: n for k, n in total.items() if n >= 3}


def test_runs_are_joined_and_merged_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, fanout=9)
    for batch in range(3):
        runs.add(spark.range(500).selectExpr(f"id * {batch + 1} AS h1", "id AS h2", "1L AS n_docs", "id AS max_id"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get(runs.ORDERED)
    spark.conf.set(runs.ORDERED, "true")
    unseen = plan(runs.unseen(runs.additions[0]))
    merging = plan(line_dedup._merged(runs.runs()[0], runs.additions[0]))
    spark.conf.set(runs.ORDERED, before)
    assert merging.count("SortMergeJoin") == 1 and "Exchange" not in merging and "Sort [" not in merging
    assert unseen.count("SortMergeJoin") == 3 and "Exchange" not in unseen and "Sort [" not in unseen
    found = {(r.h1, r.h2): r.n_docs for r in runs.repeated(2).collect()}
    assert found == {(0, 0): 3} and len(runs.runs()) == 1 and not runs.additions
    names = set(runs.names.values())
    runs.drop()
    assert names and not names & {t.name for t in spark.catalog.listTables()}


def test_shards_hold_every_row_once(messy_rows, messy, clashing):
    for docs in (messy, clashing):
        rows = histogram_shards.shard(docs, 5, rows_per_piece=3).collect()
        size = lambda text: len((text or "").encode()) + 8
        assert Counter((r.doc_id, r.text, r["size"]) for r in rows) == Counter((*r[:2], size(r[1])) for r in messy_rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert set(slots) <= set(range(5))
        assert {"lang", "source", *docs.columns} <= set(rows[0].asDict())


def test_shards_are_even_with_a_hot_group(spark, prose, empty):
    copy = prose(40)
    rows = [(i, copy if i % 3 == 0 else prose(10 + i % 60)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = histogram_shards.shard(docs, 8).groupBy("shard").agg(F.sum("size")).collect()
    sizes = [r[1] for r in found]
    assert len(sizes) == 8 and max(sizes) < 1.06 * min(sizes)
    assert histogram_shards.shard(empty, 8).count() == 0


def test_pieces_are_bounded_where_texts_are_empty(spark):
    """A third of the rows are empty texts: next to nothing in bytes, one stretch of keys."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 > 0 THEN repeat(concat('text ', id, ' '), 40) END AS text")
    keys = docs.select(histogram_shards.sort_key("doc_id", "text").alias("key"), F.expr("coalesce(octet_length(text), 0) + 8L").alias("size"))
    _, by_bytes = histogram_shards.splitters(keys, 4 * 8)
    cuts, rows, owner = histogram_shards.cut_pieces(keys, 4, 0.02, 100, 4)
    assert by_bytes.max() > 800 and rows.max() <= 100 and rows.sum() == 3000 and len(rows) == len(cuts) + 1
    found = histogram_shards.shard(docs, 4, rows_per_piece=100).collect()
    plain = histogram_shards.shard(docs, 4, rows_per_piece=3000).collect()
    for some in (found, plain):
        for k in range(4):
            own = [r for r in some if r.shard == k]
            assert sorted(r.slot for r in own) == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - sum(r["size"] for r in some) / 4) < 2500
    assert len(found) == len({r.doc_id for r in found}) == 3000
    assert set(owner) == {0, 1, 2, 3}


def test_pieces_are_bounded_where_texts_are_long(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat(id, ' '), 20000) AS text")
    keys = docs.select(histogram_shards.sort_key("doc_id", "text").alias("key"), F.expr("octet_length(text) + 8L").alias("size"))
    cuts, rows, owner = histogram_shards.cut_pieces(keys, 4, 0.02, 100_000, 1, bytes_per_piece=1 << 20)
    held = np.zeros(len(rows), np.int64)
    longest = 0
    for row in keys.collect():
        held[np.searchsorted(cuts, row.key, side="right")] += row["size"]
        longest = max(longest, row["size"])
    assert len(rows) >= 30 and held.max() <= 1.04 * (1 << 20) + 2 * longest and rows.sum() == 400
    found = histogram_shards.shard(docs, 4, bytes_per_piece=1 << 20).groupBy("shard").agg(F.sum("size"), F.count("*"), F.max("slot")).collect()
    assert len(found) == 4 and all(r[2] == r[3] + 1 for r in found)
    sizes = [r[1] for r in found]
    assert max(sizes) - min(sizes) <= 2 * longest + 0.04 * max(sizes)


def test_borders_spare_small_groups(spark):
    """Groups of six copies, far below the tolerance of a shard: none lies in two shards, and shards stay even."""
    docs = spark.range(24000).selectExpr("id AS doc_id", "concat('text number ', floor(id / 6)) AS text")
    found = histogram_shards.shard(docs, 5).groupBy("text").agg(F.count_distinct("shard")).where("`count(DISTINCT shard)` > 1")
    assert found.count() == 0
    sizes = [r[1] for r in histogram_shards.shard(docs, 5).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 5 and max(sizes) <= 1.04 * min(sizes)


def test_splitters_count_exactly(spark):
    rng = random.Random(1)
    data = [(rng.choice([5, 5, 5, 6, rng.randint(0, 1 << 62)]), rng.randint(1, 50)) for _ in range(2000)]
    keys = spark.createDataFrame(data, "key long, size long")
    cuts, rows = histogram_shards.splitters(keys, 6)
    place = np.searchsorted(cuts, [k for k, _ in data], side="right")
    assert np.bincount(place, minlength=6).tolist() == rows.tolist()


def test_components_equal_brute_force(messy_rows, messy, clashing):
    key = lambda r: tuple(map(str, r))
    expected = sorted(((i, p - (p >> 63 << 64), c) for i, p, c in brute.components([r[:2] for r in messy_rows])), key=key)
    for docs in (messy, clashing):
        assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=key) == expected


def test_one_of_each_component(messy_rows, messy, clashing, empty):
    found = brute.components([r[:2] for r in messy_rows])
    roots = brute.groups([p for _, p, _ in found])
    named = {roots[p]: c for _, p, c in found}
    for docs in (messy, clashing):
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, named.values()))
    assert simhash.one_of_each(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_rows_without_id_only_stay_alone(spark):
    docs = spark.createDataFrame([(None, "same text here"), (None, "same text here"), (None, "other words again now"), (3, "Other words again now")], "doc_id long, text string")
    assert sorted(map(str, simhash.one_of_each(docs).collect())) == sorted(["Row(doc_id=None, text='same text here')", "Row(doc_id=3, text='Other words again now')"])


@pytest.mark.parametrize("max_bits", [1, 3, 4])
def test_links_equal_all_pairs(spark, max_bits):
    rng = random.Random(max_bits)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = [p - (p >> 63 << 64) for p in sorted(prints)]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    got = sorted(map(tuple, simhash.links(frame, max_bits).collect()))
    expected = sorted((min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits)
    assert got == expected and expected


def test_long_chains_connect(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(299) if i % 100 != 99] + [(500, 500 + i) for i in range(1, 200)]
    frame = spark.createDataFrame(edges, "low long, high long")
    got = {r.node: r.root for r in simhash.components(frame, Scratch(spark)).collect()}
    for begin in (0, 100, 200):
        assert {got[x] for x in order[begin : begin + 100]} == {min(order[begin : begin + 100])}
    assert {got[500 + i] for i in range(200)} == {500}


def test_size_is_the_text_plus_eight(messy):
    row = histogram_shards.shard(messy.where("doc_id = 9"), 2).first()
    assert row["size"] == len(row.text.encode()) + 8 and zlib.crc32(row.text.encode())


def test_links_broadcast_no_side(spark):
    """The keys of a fingerprint are many times its size: none of them may go through the driver."""
    distinct = spark.range(50).select(F.xxhash64("id").alias("fingerprint"))
    plan = simhash.links(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
