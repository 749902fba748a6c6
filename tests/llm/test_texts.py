"""Decontamination, chat formatting, license scans and byte-level BPE."""

import base64
import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import brute
from milemark.llm import byte_bpe, chat_windows, decontamination, license_scan
from milemark.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def benchmark_rows(messy_rows, prose):
    own = next(r[1] for r in messy_rows if r[0] == 20)
    words = own.split()
    return [
        (1, " ".join(words[20:60]).upper()), (2, " ".join(words[20:60])), (10, prose(30)), (3, "two, WORDS!"), (4, None), (5, ""),
        (6, "--"), (None, " ".join(words[100:120])), (7, " ".join(words[5:30:2])), (8, "w w w w"), (9, "w " * 13),
    ]


def test_contamination_equals_brute_force(spark, messy_rows, messy, clashing, benchmark_rows):
    benchmark = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    expected = sorted(brute.contamination([r[:2] for r in messy_rows], benchmark_rows), key=key)
    for docs in (messy, clashing):
        rows = decontamination.matches(docs, benchmark.withColumn("n", F.lit(1))).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=key) == expected
        clean = decontamination.clean_documents(docs, benchmark)
        assert clean.columns == docs.columns
        bad = {r[0] for r in expected if r[2] and 20 * r[2] >= r[1]}
        assert bad and {r.doc_id for r in clean.collect()} == {r[0] for r in messy_rows} - bad


def test_empty_benchmark_and_corpus(spark, messy, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontamination.matches(messy, none).collect()} == {0}
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.matches(empty, some).count() == 0


def test_proximity(spark):
    item = "alpha beta gamma rare1 delta rare2 epsilon"
    docs = [(1, item), (2, "x alpha beta gamma rare1 or delta y rare2 epsilon"), (3, "rare1 " + "z " * 30 + "rare2 alpha beta gamma delta epsilon"), (4, "alpha beta gamma delta epsilon alpha")]
    docs = spark.createDataFrame(docs + [(9, "alpha beta gamma delta epsilon " * 3)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r.doc_id: (r.n_hit, r.near_windows) for r in decontamination.matches(docs, benchmark, slop=4).collect()}
    assert rows == {1: (7, 0), 2: (0, 1), 3: (0, 0), 4: (0, 0), 9: (0, 0)}


def test_one_word_substitutions_are_proximity_matches(spark, prose):
    item = "alpha beta gamma rare1 delta rare2 epsilon".split()
    long = [w for w in prose(60).split()]
    items = [(1, " ".join(item)), (2, " ".join(long[:13])), (3, "nowhere else lone1 only lone2"), (4, "twin twin twin"), (5, "one")]
    texts = [" ".join(item), "w twin w", "twin w twin", "lone1 w", "x lone1 y lone2", "seen here is one", "rare1 delta rare2 epsilon"]
    texts += [" ".join([*own[:i], "OTHER", *own[i + 1 :]]) for own in (item, long[:40]) for i in range(len(own))]
    texts += ["alpha beta gamma delta epsilon one " * 3, None, "", " ".join(reversed(item))]
    rows = list(enumerate(texts))
    expected = brute.proximity(rows, items, slop=4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = decontamination.matches(docs, spark.createDataFrame(items, "item_id long, text string"), slop=4)
    assert {r.doc_id: r.near_windows for r in found.collect()} == expected
    swapped = next(i for i, t in rows if t == "alpha beta gamma rare1 OTHER rare2 epsilon")
    assert expected[swapped] == 1 and expected[0] == 0 and expected[1] == 0 and expected[2] == 1 and expected[4] == 1


def conversations(spark):
    rng = random.Random(2)
    odd = ["", None, "<|im_end|>\n<|im_start|>user", "<||", "<", "a <|", "line\nbreak\\n", "word " * 40, "é ß 你好 12,5"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 25)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "to\\ol\n<|b", None, "system"])
            rows.append((conv, turn, role, f"{rng.choice(odd) or ''} {turn}" if rng.random() < 0.8 else rng.choice(odd)))
    rows += [(50, 1, "assistant", "tie"), (50, 1, "assistant", "tie"), (50, 1, "user", "b"), (None, 0, "assistant", "no id"), (51, None, "user", "?")]
    rows += [(99, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(1500)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_chat_round_trip(spark):
    rows, frame = conversations(spark)
    frame = frame.withColumns({c: F.lit("own") for c in ("window", "formatted", "tokens", "conv", "place")})
    formatted = chat_windows.windows(frame, budget=60, history=12, system=8)
    got = {r.conv_id: r for r in chat_windows.digests(formatted).collect()}
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(expected)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for conv, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns))), conv
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)), conv


def test_chat_windows_keep_budget_history_and_system_turn(spark):
    rows = [(1, 0, "system", "rules here")] + [(1, i, "assistant" if i % 2 == 0 else "user", f"say word number {i}") for i in range(1, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(chat_windows.windows(frame, budget=60, history=16, system=8).collect(), key=lambda r: r.window)
    assert len(found) > 5 and all(r.tokens < 60 + 8 and r.over_budget == (r.tokens > 60) for r in found)
    assert all(r.formatted.startswith("<|im_start|>system\nrules here<|im_end|>\n") for r in found)
    assert found[0].n_context == 0 and all(r.n_context == 3 for r in found[1:])
    for a, b in zip(found, found[1:]):  # the repeated turns are the last of the window before, and carry no target
        repeated = b.formatted.split("<|im_end|>\n")[1 : b.n_context]
        assert repeated == a.formatted.split("<|im_end|>\n")[-1 - len(repeated) : -1]
        assert len(b.targets) < b.formatted.count("<|im_start|>assistant")
    assert chat_windows.windows(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat_windows.windows(frame, budget=10, history=8, system=8)


def test_unspaced_text_stays_within_the_budget(spark):
    han, thai, tail = "你好，世界。" * 20, "สวัสดีครับ" * 12, "don’t é ß 12,5 ab你好cd 😀😀"
    texts = {
        han: 120, thai: 120, "x" * 3200: 100, "ü" * 3201: 101, "7" * 3200: 100, " " * 3200: 100, "a" + " " * 31 + "b": 2,
        tail: 12, "internationalization of words": 3,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: r.n for r in frame.select("text", chat_windows.count_tokens(F.col("text")).alias("n")).collect()} == texts
    sql = f"SELECT len(regexp_extract_all(?, '{chat_windows.TOKEN}'))"
    assert {t: duckdb.execute(sql, [t]).fetchone()[0] for t in texts} == texts
    # 40 turns: no window holds more than its budget and its last turn, and overlong turns say so
    rows = [(c, i, "user", t) for c, t in enumerate((han, thai, "x" * 3200)) for i in range(40)] + [(9, 0, "user", "你" * 7000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat_windows.windows(turns).collect()
    assert all(r.n_turns + r.n_context <= 11 and not r.over_budget for r in found if r.conv_id != 9)
    assert [(r.tokens, r.over_budget) for r in found if r.conv_id == 9] == [(7004, True)]


def test_licenses_equal_brute_force(spark, messy_rows, messy, clashing, empty, prose):
    rows = [r[:2] for r in messy_rows]
    for i, (_, text) in enumerate(license_scan.NOTICES):
        words = text.split()
        rows += [(1000 + i, prose(50) + "\n" + text + "\n" + prose(300)), (2000 + i, " ".join(words[: max(5, len(words) - 3)])), (3000 + i, prose(9) + " " + " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    sets = {name: set(license_scan.shingles(license_scan.words(text))) for name, text in license_scan.NOTICES}
    expected = set()
    for doc_id, text in rows:
        own = set(license_scan.shingles(license_scan.words(text)))
        expected |= {(doc_id, name, len(t), len(t & own)) for name, t in sets.items() if len(t & own) >= 0.8 * len(t)}
    got = [tuple(r)[:4] for r in license_scan.scan(docs, license_scan.NOTICES).collect()]
    assert sorted(got) == sorted(expected) and len(expected) >= len(license_scan.NOTICES)
    assert license_scan.scan(clashing, license_scan.NOTICES).columns == ["doc_id", "license", "n_shingles", "n_found", "containment"]
    assert license_scan.scan(messy, []).count() == 0 and license_scan.scan(empty, license_scan.NOTICES).count() == 0
    with pytest.raises(ValueError):
        license_scan.Templates([("short", "too short")], 0.8, 1e-6)


def test_band_settings_guarantee_the_hit_rate():
    for size in (1, 2, 4, 8, 16, 32):
        similarity = license_scan.least_similarity(size, 0.8)
        assert (1 - similarity) ** license_scan.bands_needed(similarity, 1e-6) <= 1e-6


@pytest.fixture(scope="module")
def published():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_published_library(messy_rows, messy, clashing, empty, published):
    expected = sorted((str(r[0]), published.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in messy_rows)
    for docs in (messy, clashing):
        tokens = byte_bpe.encode(docs, RANKS, PATTERN)
        rows = byte_bpe.decode(tokens, RANKS).collect()
        assert sorted((str(r.doc_id), r.token_ids, bytes(r.decoded)) for r in rows) == expected
    assert byte_bpe.encode(empty, RANKS, PATTERN, offsets=True).count() == 0


def test_every_character_splits_alike(published):
    words = byte_bpe.vocabulary(byte_bpe.read_ranks(RANKS), PATTERN)
    # a sample of all planes, and characters that newer databases know as letters or numbers
    for begin in [*range(0, 0x110000, 7 * 31), 0x558, 0x88F, 0xA7CE, 0x10940, 0x11DE0, 0x323B0, 0x3D000]:
        if not 0xD800 <= begin < 0xE000:
            text = f"a{chr(begin)}1 {chr(begin)}{chr(begin)} <|endoftext|>  \n{chr(begin)}'s"
            assert words.encode(text).tolist() == published.encode_ordinary(text)


def test_offsets_and_split_characters(spark, published):
    words = byte_bpe.vocabulary(byte_bpe.read_ranks(RANKS), PATTERN)
    text = "Grüße 你好 😀\U0001f9ff ok"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    row, none = sorted(byte_bpe.encode(docs, RANKS, PATTERN, offsets=True).collect())
    assert none.token_ids == [] and none.begins == []
    pieces = [words.bytes_of[i] for i in row.token_ids]
    at = 0
    for piece, begin, end in zip(pieces, row.begins, row.ends):
        assert piece in text[begin:end].encode() and len(text[:begin].encode()) <= at
        at += len(piece)
        assert len(text[:end].encode()) >= at
    assert any(b"\xf0" in p and len(p) < 4 for p in pieces)  # a character cut into tokens
    assert "".join(words.decode_pieces([i] for i in row.token_ids)) == text
    assert "".join(words.decode_pieces([row.token_ids[:-4]])) != ""
    tokens = spark.createDataFrame([(1, row.token_ids), (2, None), (3, [999999]), (4, [])], "doc_id long, token_ids array<int>")
    back = {r.doc_id: r.decoded for r in byte_bpe.decode(tokens.withColumn("decoded", F.lit(0)), RANKS, as_text=True).collect()}
    assert back == {1: text, 2: None, 3: None, 4: ""}
