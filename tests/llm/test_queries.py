"""The registered queries and the pipeline over a small folder, against SQL and plain Python."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as contract
import brute
import corpus_pipeline
from check import table
from milemark.llm import license_scan, toxicity
from milemark.llm.queries import THRESHOLD, toxicity_model
from test_texts import published  # noqa: F401


@pytest.fixture(scope="module")
def rows(messy_rows, prose):
    """Documents with distinct ids: the messy ones, license notices, and texts with insults."""
    out = {r[0]: r for r in messy_rows if r[0] is not None}
    for i in range(120):
        text = prose(40)
        if i % 4 == 0:
            text = " ".join(w if k % 9 else f"zgrob{'xyz'[k % 3]}a" for k, w in enumerate(text.split(" ")))
        out[1000 + i] = (1000 + i, text, "en", f"s{i % 3}")
    for i, (_, text) in enumerate(license_scan.NOTICES):
        out[2000 + i] = (2000 + i, f"{prose(20)}\n{text}", "en", "s0")
    return list(out.values())


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    words = next(r[1] for r in rows if r[0] == 20).split()
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, 1, int((i - 1000) % 4 == 0)) for i in range(1000, 1120)]
    items = [(1, " ".join(words[20:60])), (2, "no such words here at all"), (3, None)]
    turns = [(c, t, ["system", "user", "assistant"][t % 3], None if t == 4 else f"say {c} <|im_end|> {t}") for c in range(5) for t in range(12)]
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
        "conversations": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


SQL_CHECKED = ["op1_quality_rules", "op3_line_dedup", "op7_decontamination", "op8_chat_formatting", "op12_prefix_trie", "op13_ranked_search"]


@pytest.mark.parametrize("name", SQL_CHECKED)
def test_equal_to_sql(spark, folder, name):
    db = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = contract.queries()[name](spark, folder)
    cursor = db.execute(contract.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in cursor.description], cursor.fetchall())


def test_toxicity_query(spark, folder, rows):
    found = {r.doc_id: r for r in contract.queries()["op2_toxicity"](spark, folder).collect()}
    assert set(found) == {r[0] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.values())
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found.values())
    held = [i for i in range(1000, 1120) if found[i].held_out]
    assert sum(found[i].predicted == int((i - 1000) % 4 == 0) for i in held) >= 0.9 * len(held)


def test_sharding_query(spark, folder, rows):
    found = contract.queries()["op4_sharding"](spark, folder).collect()
    size = {r[0]: len((r[1] or "").encode()) + 8 for r in rows}
    crc = {r[0]: zlib.crc32((r[1] or "").encode()) for r in rows}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in found} == {i: (size[i], crc[i]) for i in size}
    slots = defaultdict(list)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = [sum(r["size"] for r in found if r.shard == k) for k in range(24)]
    # the one document of a large part of all bytes apart, no shard exceeds its share by more than a document
    assert sorted(loads)[-2] <= sum(loads) / 24 + 2 * sorted(size.values())[-2]


def test_simhash_query(spark, folder, rows):
    found = sorted(map(tuple, contract.queries()["op5_simhash_near_dedup"](spark, folder).collect()))
    assert found == sorted((i, f"{p:016x}", c) for i, p, c in brute.components([r[:2] for r in rows]))


def test_language_query(spark, folder, rows):
    found = {r.doc_id: r for r in contract.queries()["op6_language_id"](spark, folder).collect()}
    assert set(found) == {r[0] for r in rows}
    for i, text, *_ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert (found[i].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))


def test_license_query(spark, folder, rows):
    found = sorted(tuple(r)[:4] for r in contract.queries()["op9_license_scan"](spark, folder).collect())
    sets = {name: set(license_scan.shingles(license_scan.words(text))) for name, text in license_scan.NOTICES}
    expected = []
    for i, text, *_ in rows:
        own = set(license_scan.shingles(license_scan.words(text)))
        expected += [(i, name, len(s), len(s & own)) for name, s in sets.items() if len(s & own) >= 0.8 * len(s)]
    assert found == sorted(expected) and len(found) >= len(sets)


def _tokens(published, text):  # noqa: F811
    ids = published.encode_ordinary(text or "")
    return len(ids), brute.sha(",".join(map(str, ids))), hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_query(spark, folder, rows, published):  # noqa: F811
    found = sorted(map(tuple, contract.queries()["op10_byte_level_bpe"](spark, folder).collect()))
    assert found == sorted((r[0], *_tokens(published, r[1])) for r in rows)


def test_pipeline_equals_brute_force(spark, folder, rows, published):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity_model(docs, labels)).collect()}
    left = [r for r in rows if scores[r[0]] < THRESHOLD]
    assert 0 < len(left) < len(rows)
    kept = {i: text for i, _, _, text in brute.line_dedup([r[:2] for r in left])}
    left = [(i, kept[i]) for i, *_ in left]
    best = {c for _, _, c in brute.components(left)}
    left = [r for r in left if r[0] in best]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {i for i, n, h, _ in brute.contamination(left, items) if h and 20 * h >= n}
    assert hit
    expected = sorted((i, *_tokens(published, text)) for i, text in left if i not in hit)
    found = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()) == expected
    again = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        again = stage(spark, again, folder)
        assert again.columns == docs.columns, name


def test_pipeline_of_odd_tables(spark, clashing, empty, folder):
    """Null and repeated ids, clashing columns, and no rows at all go through every stage."""
    for docs in (clashing, empty):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert set(docs.columns) == set(columns)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
