"""The prefix trie and the ranked search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from milemark.llm import prefix_trie, term_pipeline

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows, group=100, most=6):
    """Every node's row, by walking all rebuilt conversations."""
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(found)] for c, found in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(math.fmod(c, group))
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, found in members.items()
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def grown(rng, n_convs, longest):
    """Conversations that follow each other for a while and then part."""
    paths = []
    for _ in range(n_convs):
        start = rng.choice(paths)[: rng.randint(0, longest)] if paths and rng.random() < 0.8 else []
        paths.append((start + [rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(0, longest))])[:longest])
    ids = rng.sample(range(-150, 900), n_convs)
    return [(c, t, "user" if t % 2 else "assistant", text) for c, path in zip(ids, paths) for t, text in enumerate(path)]


@pytest.mark.parametrize("chunk,longest", [(1, 9), (2, 21), (4, 16), (8, 5)])
def test_trie_equals_brute_force(spark, chunk, longest):
    rows = grown(random.Random(chunk), 60, longest)
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(5), chunk=chunk)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in found.dtypes[:-1]} == {"bigint"}
    assert rows_of(found) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(c, t, "user", "hello") for c in range(300, 330) for t in range(2)]
    rows += [(7, None, None, None), (7, None, "user", "x"), (7, 1, "user", "x"), (7, 1, "user", "x"), (7, 1, "user", "a\nb"), (None, 1, "user", "nobody")]
    rows += [(99, t, "user", "é" * (t % 3)) for t in range(70)] + [(-1, 0, "user", None), (100, 0, "", ""), (8, 5, "user", "long " * 100_000)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    wanted = brute_trie(rows)
    assert rows_of(prefix_trie.prefix_trie(df, chunk=4)) == wanted
    names = ["name", "k", "place", "digest", "chars", "conv", "range", "base", "depth", "parent", "entry"]
    assert rows_of(prefix_trie.prefix_trie(df.withColumns({c: F.lit(c) for c in names}), chunk=4)) == wanted
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).collect() == []


def test_conversations_that_end_at_the_root(spark):
    # conversation 1 of an absent base: all its turns may be before its head's length
    few = [(c, 0, "user", f"t{c}") for c in range(1, 60)]
    found = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(few, TURNS)))
    assert found == brute_trie(few) and found[0][:2] == (1, 0) and found[0][3] == 59


def test_one_long_conversation_and_ids_over_many_slices(spark):
    rows = [(5, t, "user", f"w{t % 7}") for t in range(700)] + [(100_000 + 997 * i, 0, "user", "same") for i in range(300)]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(6))) == brute_trie(rows)


def test_turns_are_ordered_over_several_ranges(spark):
    rows = [(1, None if t < 40 else t // 3, "user", f"w{t % 5}") for t in range(400)]
    df = spark.createDataFrame(rows, TURNS)
    from milemark.llm.batches import Scratch

    placed = prefix_trie.place_turns(df, Scratch(spark)).orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, 401))
    order = sorted((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()) for _, t, r, x in rows)
    assert [bytes(r.digest) for r in placed] == [x[2] for x in order]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(term_pipeline.UPPER, term_pipeline.LOWER)


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute_search(docs, items, top):
    texts = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(words(text))
    n_docs, n_terms = len(texts), sum(n for _, _, n in texts)
    df = Counter(w for _, c, _ in texts for w in c)
    out = []
    for item, terms in queries.items():
        scores = []
        for doc, counts, n in texts:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            total = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * counts[w]) // (1000 * counts[w] + 20 * m))
                for w in terms if counts[w]
            )
            if total > 0:
                scores.append((-total, doc is not None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_split_terms_equal_the_pattern(spark):
    texts = ["", "a_b É x \x7f9\x00Zz", " em ＡB\U0001f600c İI", "\r\n\t--", "x" * 100_000, None]
    assert [[t.decode() for t in term_pipeline.split_terms(t)] for t in texts] == [words(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    rows = df.select("i", term_pipeline.query_terms(F.col("text")).alias("w")).collect()
    assert all(r.w == list(dict.fromkeys(words(texts[r.i]))) for r in rows)


@pytest.mark.parametrize("top", [1, 5, 50])
def test_search_equals_brute_force(spark, top):
    rng = random.Random(top)
    pool = [f"w{i}" for i in range(400)]
    # frequencies fall steeply, so that all owner stages have terms; many equal scores
    draw = lambda n: " ".join(rng.choices(pool, [1 / (i + 1) ** 1.3 for i in range(400)], k=n))
    copies = [draw(30) for _ in range(5)]
    docs = [(i, rng.choice(copies) if i % 3 == 0 else draw(rng.randint(1, 60))) for i in range(3000)]
    docs[10] = (10, " ".join(["w1"] * 4000 + ["w399"]))
    items = [(i, draw(rng.randint(1, 25)) + (" w399 w380 w350" if i % 2 else "")) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    found = term_pipeline.search(df, spark.createDataFrame(items, "item_id long, text string"), top=top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert found_rows(found) == brute_search(docs, items, top)


def test_search_over_odd_rows(spark, messy_rows, messy, clashing, empty):
    docs = [(r[0], r[1]) for r in messy_rows]
    some = next(r[1] for r in messy_rows if r[0] == 20)
    items = [(1, some[:300]), (2, None), (3, "...!"), (None, "one two WORDS"), (4, "nowhere at all zzqq"), (1, "repeated row"), (5, "no id but")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    wanted = brute_search(docs, items, 8)
    assert found_rows(term_pipeline.search(messy, queries, top=8)) == wanted
    more = queries.withColumns({c: F.lit(c) for c in ("term", "weight", "stage", "bucket", "block", "id", "item")})
    assert found_rows(term_pipeline.search(clashing, more, top=8)) == wanted
    for a, b in ((empty, queries), (messy, queries.limit(0)), (messy, queries.where("item_id = 3")), (messy, queries.where("item_id = 2"))):
        assert term_pipeline.search(a, b).collect() == []


def test_search_by_shuffled_routes_and_many_buckets(spark, messy, messy_rows, monkeypatch):
    monkeypatch.setattr(term_pipeline, "BROADCAST_ROUTES", 0)
    monkeypatch.setattr(term_pipeline, "BUCKET", 2)
    docs = [(r[0], r[1]) for r in messy_rows]
    some = next(r[1] for r in messy_rows if r[0] == 20).split()
    items = [(i, " ".join(some[i : i + 9])) for i in range(0, 90, 9)]
    found = term_pipeline.search(messy, spark.createDataFrame(items, "item_id long, text string"), top=6)
    assert found_rows(found) == brute_search(docs, items, 6)


def test_blocks_are_bounded(spark):
    docs = spark.range(10_000).selectExpr("id", "concat('a b', id % 3) as text").coalesce(1)
    terms = spark.createDataFrame([("a",), ("b1",)], "term string")
    rows = term_pipeline.build_index(docs, terms).collect()
    own = [r for r in rows if r.term is None]
    assert sorted(len(r.ids) for r in own) == [10_000 - 2 * term_pipeline.BLOCK, term_pipeline.BLOCK, term_pipeline.BLOCK]
    assert sum(len(r.slots) for r in rows if r.term == "a") == 10_000
    assert sorted(i for r in own for i in r.ids) == list(range(10_000))
