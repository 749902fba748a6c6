"""Language identification against plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from milemark.llm import language_id


class Brute:
    """All counts in dictionaries; whole millionths as in the operator."""

    def __init__(self, rows):
        self.languages = sorted({lang for _, lang in rows})
        self.words = self.counted((lang, w, 1) for text, lang in rows for w in language_id.WORD.findall(text.lower()))
        each = [(lang, w, n) for w, by in self.words.items() for lang, n in by.items()]
        self.grams = {size: self.counted((lang, g, n) for lang, w, n in each for g in language_id.grams_of(w, size)) for size in (1, 2, 3, 4)}

    def counted(self, found):
        out = {}
        for lang, key, n in found:
            out.setdefault(key, Counter())[lang] += n
        return out

    def logs(self, table, key):
        totals = {lang: sum(by[lang] for by in table.values()) for lang in self.languages}
        return [math.floor(math.log((table[key][lang] + 0.5) / (totals[lang] + 0.5 * len(table))) * language_id.UNIT) for lang in self.languages]

    def gram(self, g):
        if g in self.grams[len(g)]:
            return self.logs(self.grams[len(g)], g)
        if len(g) == 1:
            return [0] * len(self.languages)
        return [math.floor((a + b) / 2) for a, b in zip(self.gram(g[:-1]), self.gram(g[1:]))]

    def word(self, w):
        if w in self.words:
            return self.logs(self.words, w)
        found = [self.gram(g) for g in language_id.grams_of(w, min(language_id.LONGEST, len(w) + 2))]
        return [math.floor(sum(x) / len(found)) for x in zip(*found)]

    def predict(self, text):
        counts = Counter(language_id.WORD.findall((text or "").lower()))
        if not counts or not self.languages:
            return "und", 0.0
        total = [0] * len(self.languages)
        for w, n in counts.items():
            total = [t + n * x for t, x in zip(total, self.word(w))]
        best = max(total)
        return self.languages[total.index(best)], 1 / sum(math.exp((t - best) / language_id.UNIT) for t in total)


@pytest.fixture(scope="module")
def taught(prose):
    """(text, lang): three made-up languages that share letters and some words."""
    rng = random.Random(11)
    sounds = {"aa": ["ka", "lo", "mi", "the"], "bb": ["ko", "la", "mü", "und"], "cc": ["shi", "lo", "tsu", "no"]}
    word = lambda lang: "".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4)))
    return [(" ".join(word(lang) for _ in range(rng.randint(1, 40))).capitalize() + ".", lang) for lang in sounds for _ in range(40)]


TEXTS = [
    None, "", "12 !?", "the", "The,und", "kalomi kaloshi", "zzzz", "ka2lo lo_mi", "漢字 mü", "x", "K" * 300 + " lo " + "lo" * 90,
    "tsuno mülakoko\xa0thethethe\u2003no", "Σίσυφος ΣΑΣ", "kaka lala no no no no no qq",
]


@pytest.mark.parametrize("head", [0, 7, 60_000])
def test_equal_to_brute_force_whatever_the_head(spark, taught, messy, head):
    brute = Brute(taught)
    docs = spark.createDataFrame([(*r, 1) for r in taught] + [("kept out", "dd", 0), ("no language", None, 1), (None, "aa", 1)], "text string, lang string, t int")
    model = language_id.train(docs, F.col("t") == 1, head_words=head)
    assert model.languages == ["aa", "bb", "cc"] and len(model.head[0]) <= head
    if head == 7:
        assert 0 < len(model.head[0])
    texts = TEXTS + [text for text, _ in taught[::9]] + [r.text for r in messy.collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(rows, model).collect()}
    for i, text in enumerate(texts):
        lang, score = brute.predict(text)
        assert found[i][0] == lang and found[i][1] == pytest.approx(score, rel=1e-4), text


def test_more_words_than_any_head(spark):
    """Rare words count as learned, however many there are."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i: "".join(letters[i // 26**k % 26] for k in range(4))
    docs = spark.range(70_000).select(F.concat_ws("", *[F.element_at(F.split(F.lit(letters), ""), (F.expr(f"id div {26**k}") % 26 + 1).cast("int")) for k in range(4)]).alias("text"),
                                      F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("lang"))
    model = language_id.train(docs, F.lit(True), head_words=60_000)
    asked = [(i, name(i)) for i in range(0, 70_000, 611)]
    found = language_id.identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {i: "odd" if i % 2 else "even" for i, _ in asked}


def test_pieces_keep_every_word():
    for text in TEXTS[1:]:
        words = [w for piece in language_id.pieces(text) for w in language_id.words_of(piece)]
        assert words == language_id.WORD.findall(text.lower())
    for piece in ("...", "a.b", "(x²)", "½", "-un-", "a_", "é", "e\u0301", "٣", "_", "'s"):
        assert language_id.words_of(piece) == language_id.WORD.findall(piece)


def test_forgotten_pieces_are_read_again(monkeypatch):
    import numpy as np

    monkeypatch.setattr(language_id, "HELD", 5)
    known = language_id._Pieces(["k"], np.array([[-1, -2]]))
    first = [known.read(f"q{c}q k") for c in "abcdefghij"]
    assert [(t.tolist(), r) for t, r in first] == [([-1, -2, 2], {f"q{c}q": 1}) for c in "abcdefghij"] and len(known) < 9


def test_nothing_learned(spark, empty, messy):
    for model in (language_id.train(empty, F.lit(True)), language_id.train(messy.where("lang = 'xx'"), F.lit(True)), language_id.train(messy.withColumn("text", F.lit("1 2")), F.lit(True))):
        assert {(r.lang_pred, r.score) for r in language_id.identify(messy, model).collect()} == {("und", 0.0)}
        assert language_id.identify(empty, model).count() == 0


def test_language_on_held_out_rows(spark, small, messy, clashing):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language_id.train(docs, ~held)
    found = language_id.identify(docs, model).join(docs.where(held).where("lang is not null"), "doc_id")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.95
    learned = set(model.languages)
    for table in (messy, clashing.withColumns({c: F.lit(c) for c in ("row", "sums", "tail", "word", "gram", "logs")})):
        rows = language_id.identify(table, model).collect()
        assert len(rows) == messy.count()
        assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
        assert all(r.lang_pred in learned | {"und"} and 0 <= r.score <= 1 for r in rows)
