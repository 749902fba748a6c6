"""The compression classifier against plain Python, on odd rows, and on held-out labels."""

import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as contract
from milemark.llm import compression, samples



@pytest.fixture(scope="module")
def labelled(prose):
    """(doc_id, text, quality): prose is good; shouting, tables and one word over and over are bad."""
    rng, rows = random.Random(3), []
    for i in range(400):
        text = prose(rng.randint(20, 200))
        kind = i % 8
        if kind == 0:
            text = text.upper().replace(" ", "!! ")
        elif kind == 1:
            text = " | ".join(text.split())
        elif kind == 2:
            text = " ".join([text.split()[0]] * rng.randint(50, 400))
        rows.append((i, text, int(kind > 2)))
    return rows


@pytest.fixture(scope="module")
def model(spark, labelled):
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in labelled], "doc_id long, quality int")
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return compression.train(docs, labels, train, dictionary_bytes=16_384)


def plain_difference(model, text):
    """Both dictionaries through the library's own one-shot interface, piece by piece."""
    data, total = (text or "").encode(), 0
    for i in range(0, len(data), compression.PIECE):
        sizes = []
        for made in (model.good, model.bad):
            known = zstandard.ZstdCompressionDict(made)
            known.precompute_compress(level=compression.LEVEL)
            packed = zstandard.ZstdCompressor(compression.LEVEL, dict_data=known).compress(data[i : i + compression.PIECE])
            assert zstandard.ZstdDecompressor(dict_data=known).decompress(packed) == data[i : i + compression.PIECE]
            sizes.append(len(packed))
        total += sizes[1] - sizes[0]
    return total / len(data) if data else 0.0


def test_held_out_accuracy(spark, labelled, model):
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string")
    found = {r.doc_id: r for r in compression.score(docs, model).collect()}
    held = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = sum((found[i].score >= 0.7) == bool(q) for i, _, q in held)
    assert right >= 0.93 * len(held)


def test_scores_equal_plain_python(spark, labelled, model):
    texts = [r[1] for r in labelled[:16]] + ["é" * 700, "x", ""]
    rows = compression.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for row in rows:
        x = plain_difference(model, texts[row.doc_id])
        # dictionary ids differ in header size, equally for both dictionaries of one size class
        assert row.difference == pytest.approx(x, abs=4 * (len(texts[row.doc_id].encode()) // compression.PIECE + 1) / max(len(texts[row.doc_id].encode()), 1))
        z = model.slope * row.difference / model.scale + model.intercept
        assert row.score == pytest.approx(1 / (1 + np.exp(-z)))


def test_odd_rows(spark, messy, clashing, empty, model):
    found = compression.score(messy, model)
    assert found.columns == ["doc_id", "difference", "score"]
    rows = found.collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (1, 2)}
    assert blank == {1 / (1 + np.exp(-model.intercept))}
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert sorted(compression.score(clashing, model).collect(), key=key) == sorted(rows, key=key)
    assert compression.score(empty, model).count() == 0


def test_labels_that_teach_nothing(spark, messy, empty):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    for rows, prior in (([], 0.5), ([(20, 1), (21, 1), (4, 1)], 1.0), ([(7, 0)], 0.0), ([(20, 1), (20, 0), (None, 1), (9, None)], 0.5)):
        model = compression.train(messy, labels(rows), F.lit(True))
        assert {r.score for r in compression.score(messy, model).collect()} == {prior}
    assert compression.train(empty, labels([(1, 1), (2, 0)]), F.lit(True)).prior == 0.5


def test_curve_is_the_minimum(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=300)
    y = (rng.random(300) < 1 / (1 + np.exp(-2 * x - 0.5))).astype(float)
    weight = rng.random(300) + 0.5
    a, b = compression.fit_curve(x, y, weight, ridge=1e-6)

    def loss(a, b):
        z = a * x + b
        return (weight * (np.logaddexp(0, z) - y * z)).sum()

    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-6 for da in (-0.05, 0, 0.05) for db in (-0.05, 0, 0.05))
    split = np.r_[np.full(20, -1.0), np.full(20, 1.0)]
    slope, _ = compression.fit_curve(split, (split > 0).astype(float), np.ones(40))
    assert 0 < slope < 50


def test_pieces_cover_the_whole_text():
    assert compression.sample_pieces(b"") == []
    short = bytes(range(250)) * 4
    assert b"".join(compression.sample_pieces(short)) == short
    many = compression.sample_pieces(bytes(1_000_000))
    assert 16 < len(many) <= compression.PIECES
    long = b"a" * 500_000 + b"z" * 500_000
    cut = compression.sample_pieces(long)
    assert sum(p[:1] == b"z" for p in cut) >= len(cut) // 2 - 1


def test_smallest_hashes_equal_a_full_sort(spark):
    ids = spark.range(5000).selectExpr("id as doc_id").repartition(40)
    whole = ids.orderBy(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(samples.STEPS)), "doc_id")
    for most in (10, 700, 9000):
        wanted = {r.doc_id for r in whole.limit(most).collect()}
        assert {r.doc_id for r in samples.smallest_hashes(ids, most, 5000).collect()} == wanted


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    out = contract.queries()["op11_quality_classifier"](spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.92 * len(held)
