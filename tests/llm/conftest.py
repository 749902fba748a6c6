import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that a caller may have, named like things the operators make.
CLASHING = ["id", "row", "key", "size", "shard", "slot", "score", "fingerprint", "n_lines", "n_words", "host", "text_hash", "_drop"]


@pytest.fixture(scope="session")
def prose():
    """Reproducible sentences."""
    rng = random.Random(7)
    parts = ["an", "er", "thi", "ou", "le", "ment", "ß", "é", "tion", "ing", "ado", "Qu"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))

    def make(n_words, per_line=12):
        words = [word() for _ in range(n_words)]
        return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, n_words, per_line))

    return make


@pytest.fixture(scope="session")
def messy_rows(prose):
    """(doc_id, text, lang, source): nulls, blanks, very long texts, copies, near copies, ties and repeated rows."""
    shared = "this very line stands in many of the documents here"
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n \x0b", None, "a"), (None, "no id but " + prose(40), "en", "a"),
        (None, None, None, None), (4, prose(60) + "\n" + shared, "fr", None), (5, "one", "en", "b"), (6, "Two words", "en", "b"),
        (7, prose(30000), "de", "a"), (8, "w " * 5000, "en", "a"), (9, "\x00 odd   break \U0001f600 ÉÉ", "fr", "c"),
    ]
    body = prose(200)
    words = body.split(" ")
    for i in range(12):
        rows.append((20 + i, body if i < 8 else " ".join([*words[:-1], f"end{i}"]), "fr", "a"))
    for i in range(15):
        rows.append((50 + i, f"{prose(30)}\n  {shared.upper() if i % 2 else shared} \n{prose(20)}\n{shared}", "en", f"s{i % 4}"))
    rows += [(60, "repeated row " + prose(25), "en", "b")] * 3 + [(61, "a", "en", "b"), (61, "b", "en", "b")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in messy_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(messy):
    from pyspark.sql import functions as F

    return messy.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
