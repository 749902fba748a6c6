"""Language identification: words first, then shorter and shorter pieces of the words nobody has seen.

Training counts every word by language over all training texts, and from the words their character n-grams of length 1
to ``LONGEST`` (words padded with one blank on both sides where n > 1). Counts become smoothed log shares by language,
in whole millionths, so that sums do not depend on their order.

A known word scores by its own frequencies. Of an unknown word, the longest n-grams are looked up; where one is
unknown, the two shorter ones inside it count by half each, down to single characters. The text's language is the one
with the highest sum, where every word counts as one observation.

The model is a pair of tables without any cap. Only the most frequent words, at most ``head_words``, are sent to every
executor; they are a shortcut and change no result. Tasks remember what the blank-separated pieces of texts are worth, so
a piece is cut into words once and not at every place. Words outside the head leave the task as (text, word, count):
each distinct one is scored once, by a join with the words learned or, if unknown, with the n-grams, round by round
from long to short and back; one join brings the scores to the texts, and the texts' sums are added up.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so are all texts if nothing was
learned; ties go to the language that sorts first; rows with a null language are not learned from; repeated rows get a
result each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milemark.llm.batches import Scratch, text_slices

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 4
UNDECIDED = "und"
#: Log shares are counted in these parts of one.
UNIT = 1_000_000
#: Distinct pieces of text that a task counts before it hands them on, and that it remembers.
HELD = 300_000
#: Signs that often stand beside a word.
SIGNS = ".,;:!?\"'()[]-#$%&*|<>"
#: Characters up to which a piece is remembered whole; longer ones are cut into words first.
SHORT = 64


def pieces(text: str) -> list[str]:
    """The lower-case text cut at blanks, where no word goes on; of long pieces the words."""
    cut = text.lower().split()
    if len(text) > SHORT and any(len(x) > SHORT for x in cut):
        cut = [w for x in cut for w in ([x] if len(x) <= SHORT else WORD.findall(x))]
    return cut


def words_of(piece: str) -> list[str]:
    """The words of a piece; most pieces are one word and a sign."""
    bare = piece.strip(SIGNS)
    return [bare] if bare.isalpha() else WORD.findall(bare)


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _count_words(place: dict[str, int]):
    """(lang, word, n) of all batches of a task, handed on whenever many pieces are held; languages by number."""

    def run(batches):
        held: dict[int, Counter] = {}

        def rows():
            langs, words, n = [], [], []
            for lang, found in held.items():
                counts: dict[str, int] = {}
                for piece, times in found.items():
                    for word in words_of(piece):
                        counts[word] = counts.get(word, 0) + times
                langs += [lang] * len(counts)
                words += counts.keys()
                n += counts.values()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.int32()), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"])

        for batch in batches:
            for part in text_slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    held.setdefault(place[lang], Counter()).update(pieces(text))
                if sum(map(len, held.values())) > HELD:
                    yield rows()
        yield rows()

    return run


def _count_grams(batches):
    """(gram, n) of counted words; n is an array by language."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 20_000):
            part = batch.slice(begin, 20_000)
            words = part.column("word").to_pylist()
            counts = part.column("n").flatten().to_numpy().reshape(len(words), -1)
            rows: dict[str, int] = {}
            at, of = [], []
            for i, word in enumerate(words):
                found = [rows.setdefault(g, len(rows)) for size in range(1, LONGEST + 1) for g in grams_of(word, size)]
                at += found
                of += [i] * len(found)
            order = np.argsort(at, kind="stable")
            sums = np.add.reduceat(counts[np.array(of)[order]], np.flatnonzero(np.diff(np.array(at)[order], prepend=-1)))
            n = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), counts.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.string()), n], ["gram", "n"])


def _log_shares(totals: list[int], distinct: int) -> Column:
    """From counts ``n`` by language, the smoothed log shares of each language's total."""
    share = lambda i, total: (F.col("n")[i] + 0.5) / (total + 0.5 * max(1, distinct))
    return F.array(*[F.floor(F.log(share(i, total)) * UNIT) for i, total in enumerate(totals)])


def _head(words: DataFrame, most: int) -> pa.Table:
    """(word, logs) of the most frequent words, ``most`` of them at most.

    The least frequency comes from a histogram of the totals in logarithmic steps (some thousand rows), so nothing is
    sorted or ranked in one place; words of the step that would go beyond ``most`` stay out.
    """
    step = F.floor(F.log("total") * 64)
    left, least = most, None
    for row in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        left -= row["count"]
        if left < 0:
            break
        least = row["step"]
    return words.where(step >= F.lit(least)).select("word", "logs").toArrow()


@dataclass
class Model:
    """``words`` (word, logs) and ``grams`` (gram, logs) are tables; ``head`` has the most frequent words' rows."""

    languages: list[str]
    words: DataFrame | None = None
    grams: DataFrame | None = None
    head: tuple[list[str], np.ndarray] | None = None


def train(docs: DataFrame, train_rows: Column, head_words: int = 60_000) -> Model:
    """Learn from (text, lang) of the rows where ``train_rows`` holds. The tables stay in the shared folder."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.where(F.coalesce(train_rows, F.lit(False))).where("lang is not null and text is not null").select("lang", "text")
    languages = sorted(row.lang for row in rows.select("lang").distinct().collect())
    if not languages:
        return Model([])
    place = {lang: i for i, lang in enumerate(languages)}
    count = range(len(languages))
    found = rows.mapInArrow(_count_words(place), "lang int, word string, n long").groupBy("word")
    by_language = F.array(*[F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)) for i in count])
    words = scratch.keep(found.agg(by_language.alias("n"), F.sum("n").alias("total")), "words")
    each = F.array(*[F.sum(F.col("n")[i]) for i in count])
    grams = words.select("word", "n").mapInArrow(_count_grams, "gram string, n array<long>").groupBy("gram").agg(each.alias("n"))
    grams = scratch.keep(grams, "grams")

    sums = words.agg(each.alias("totals"), F.count("*").alias("distinct")).first()
    if not sums.distinct:
        return Model([])
    learned = scratch.keep(words.select("word", "total", _log_shares(sums.totals, sums.distinct).alias("logs")), "word_logs")
    size = F.char_length("gram")
    by_size = {row["size"]: row for row in grams.groupBy(size.alias("size")).agg(each.alias("totals"), F.count("*").alias("distinct")).collect()}
    logs = F.coalesce(*[F.when(size == n, _log_shares(row.totals, row.distinct)) for n, row in sorted(by_size.items())])
    gram_logs = scratch.keep(grams.select("gram", logs.alias("logs")), "gram_logs")
    scratch.drop(grams)
    scratch.drop(words)
    table = _head(learned, head_words)
    matrix = table.column("logs").combine_chunks().flatten().to_numpy() if table.num_rows else np.zeros(0, np.int64)
    head = table.column("word").to_pylist(), matrix.reshape(-1, len(languages))
    return Model(languages, learned.select("word", "logs"), gram_logs, head)


class _Pieces(dict):
    """Piece of text to row of a growing matrix: log sums of its head words and, last, its number of words. Row 0 is a
    single word outside the head, rows from 1 are the head's words. ``tails`` has the words outside the head of the
    pieces that have some. Forgets all but the head when it holds too much."""

    def __init__(self, words: list[str], logs: np.ndarray):
        super().__init__()
        self.place = dict(zip(words, range(1, len(words) + 1)))
        self.rows = np.zeros((len(words) + 4096, logs.shape[1] + 1), np.int64)
        self.rows[1 : len(words) + 1, :-1] = logs
        self.rows[: len(words) + 1, -1] = 1
        self.tails: dict[str, list[str]] = {}
        self.used = len(words) + 1
        self.held = 0

    def __missing__(self, piece: str) -> int:
        self.held += len(piece)
        words = words_of(piece)
        rest = [w for w in words if w not in self.place]
        if rest:
            self.tails[piece] = rest
        if len(words) == 1:
            row = self.place.get(words[0], 0)
        else:
            row = self.used
            self.used += 1
            if row >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[row] = sum((self.rows[self.place[w]] for w in words if w in self.place), np.zeros(self.rows.shape[1], np.int64))
            self.rows[row, -1] = len(words)
        self[piece] = row
        return row

    def trim(self) -> None:
        if len(self) > HELD or self.held > SHORT * HELD:
            self.clear()
            self.tails.clear()
            self.used, self.held = len(self.place) + 1, 0

    def read(self, text: str | None) -> tuple[np.ndarray, dict[str, int]]:
        """Sums of the whole text, and the counts of its words outside the head."""
        self.trim()
        counts = Counter(pieces(text or ""))
        at = list(map(self.__getitem__, counts))
        if not at:
            return np.zeros(self.rows.shape[1], np.int64), {}
        total = np.fromiter(counts.values(), np.int64, len(at)) @ self.rows[at]
        rest: dict[str, int] = {}
        for piece in counts.keys() & self.tails.keys():
            for word in self.tails[piece]:
                rest[word] = rest.get(word, 0) + counts[piece]
        return total, rest


def _read_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(row, id, n_words, sums, tail, times) of the texts (row, id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.head)

    def run(batches):
        known = _Pieces(*shared.value)
        for batch in batches:
            for part in text_slices(batch):
                found = [known.read(text) for text in part.column("text").to_pylist()]
                sums = np.array([total for total, _ in found], np.int64).reshape(len(found), -1)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(sums[:, :-1].ravel()), sums.shape[1] - 1).cast(pa.list_(pa.int64()))
                tail = pa.array([list(rest) for _, rest in found], pa.list_(pa.string()))
                times = pa.array([list(rest.values()) for _, rest in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), pa.array(sums[:, -1]), lists, tail, times],
                    ["row", "id", "n_words", "sums", "tail", "times"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, n_words long, sums array<long>, tail array<string>, times array<long>"
    return docs.select("row", "id", "text").mapInArrow(run, schema)


def resolve_grams(needed: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """(gram, logs) of the distinct n-grams ``needed``: learned, or the mean of the two shorter ones inside; an unknown
    character says nothing."""
    zero = F.array(*[F.lit(0).cast("long")] * len(model.languages))
    halves = lambda n: F.array(F.substring("gram", 1, n - 1), F.substring("gram", 2, n - 1))
    looked, wanted = {}, None
    for n in range(LONGEST, 0, -1):
        own = needed.where(F.char_length("gram") == n)
        own = own if wanted is None else own.unionByName(wanted)
        looked[n] = scratch.keep(own.distinct().join(model.grams, "gram", "left"), f"grams{n}")
        wanted = looked[n].where("logs is null").select(F.explode(halves(n)).alias("gram")) if n > 1 else None
    done = scratch.keep(looked[1].withColumn("logs", F.coalesce("logs", zero)), "resolved")
    whole = done
    for n in range(2, LONGEST + 1):
        unknown = looked[n].where("logs is null").select("gram", F.posexplode(halves(n)).alias("side", "part"))
        parts = unknown.join(done.withColumnsRenamed({"gram": "part"}), "part")
        # both sides are there
        mean = F.array(*[F.floor(F.sum(F.col("logs")[i]) / 2) for i in range(len(model.languages))])
        backed = parts.groupBy("gram").agg(mean.alias("logs"))
        done = scratch.keep(looked[n].where("logs is not null").unionByName(backed), "resolved")
        whole = whole.unionByName(done)
    return whole


def score_words(words: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """(word, logs) of distinct words: their own, or the mean of their longest n-grams."""
    looked = scratch.keep(words.join(model.words, "word", "left"), "looked_up")
    unknown = looked.where("logs is null").select("word")
    known = looked.where("logs is not null")
    if unknown.isEmpty():
        return known
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    size = F.least(F.lit(LONGEST), F.char_length(padded))
    begins = F.explode(F.sequence(F.lit(1), F.char_length(padded) - size + 1)).alias("begin")
    cut = unknown.select("word", padded.alias("padded"), size.alias("size"), begins)
    pairs = cut.select("word", F.substring(F.col("padded"), F.col("begin"), F.col("size")).alias("gram"))
    pairs = scratch.keep(pairs.groupBy("word", "gram").agg(F.count("*").alias("times")), "word_grams")
    grams = resolve_grams(pairs.select("gram").distinct(), model, scratch)
    each = [F.floor(F.sum(F.col("logs")[i] * F.col("times")) / F.sum("times")) for i in range(len(model.languages))]
    return known.unionByName(pairs.join(grams, "gram").groupBy("word").agg(F.array(*each).alias("logs")))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``lang_pred`` and ``score`` (the language's share of the likelihood) of every whole text."""
    if not model.languages:
        return docs.select(id_col, F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score"))
    scratch = Scratch(docs.sparkSession)
    count = range(len(model.languages))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = scratch.keep(_read_texts(rows, model), "texts")
    tail = texts.select("row", F.explode(F.arrays_zip(F.col("tail").alias("word"), F.col("times").alias("times"))).alias("x")).select("row", "x.*")
    scored = scratch.keep(score_words(tail.select("word").distinct(), model, scratch), "tail_logs")
    added = tail.join(scored, "word").groupBy("row").agg(F.array(*[F.sum(F.col("logs")[i] * F.col("times")) for i in count]).alias("more"))
    whole = texts.select("row", "id", "n_words", "sums").join(added, "row", "left")
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    whole = whole.select("id", "n_words", total.alias("total")).withColumn("best", F.array_max("total"))
    share = 1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp((x - F.col("best")) / UNIT))
    names = F.array(*map(F.lit, model.languages))
    found = F.col("n_words") > 0
    return whole.select(
        F.col("id").alias(id_col),
        F.when(found, F.element_at(names, F.array_position("total", F.col("best")).cast("int"))).otherwise(UNDECIDED).alias("lang_pred"),
        F.when(found, share).otherwise(0.0).alias("score"),
    )
