"""Benchmark decontamination over a distributed positional inverted index. DataFrame functions only.

Words are lower-cased in A-Z; a window is ``window`` consecutive words of a benchmark item, or a whole shorter item.
First the corpus frequency of every benchmark word is counted. Each window is looked up by the two rarest of its words
that occur in the corpus; the index holds the postings (document, position) of those words and is stored. A posting
minus the word's offset is the place where its window would begin, and two lists agree where these places are equal or
at most ``slop`` apart. Equal places are phrase candidates, unless the window has a word that the corpus lacks or would
reach over the text's end; they are compared word by word with the document's text. Windows that agree somewhere in a
document but are nowhere its phrase are proximity matches.

Words that the benchmark does not have never leave their task; Spark broadcasts the benchmark's words if they are few
and joins by shuffle otherwise, where a hot word is split. Lists are intersected inside one document and window, so
nothing grows with the number of documents that share a passage. A document's matches are gathered by document, which
its own length bounds.

Defined cases: null texts have no words; items without words are no items; equal windows of several items are looked
up once and count for each of them; repeated rows get a result each; a null item_id is counted for no document; rows
with equal id and different texts are told apart by the text's hash; an empty benchmark or corpus gives no hits or no
rows; a window of which only one word occurs has no proximity match, and one posting never stands for both words where
they are equal; other columns are ignored by ``matches`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milemark.llm.batches import Scratch
from milemark.llm.line_dedup import LOWER, UPPER

#: What separates words, after lower-casing; and the same where A-Z are still there.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS_BETWEEN_UPPER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAPS, -1), "")


def count_words(text: Column) -> Column:
    cut = F.split(F.coalesce(text, F.lit("")), GAPS_BETWEEN_UPPER, -1)  # several times faster than regexp_count
    return F.size(F.array_remove(cut, "")).cast("long")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, phrase, n): the windows of each item, as words joined by blanks."""
    cut = benchmark.select("item_id", F.explode(F.array(words(F.coalesce("text", F.lit(""))))).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    begins = cut.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    own = F.slice("w", F.col("i") + 1, F.lit(window))
    return begins.select("item_id", F.array_join(own, " ").alias("phrase"), F.size(own).alias("n")).distinct()


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (id, text_hash, n_words, term, place) of the given terms, for documents (id, text)."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("id", F.xxhash64(text).alias("text_hash"), words(text).alias("w"))
    cut = cut.select("id", "text_hash", F.size("w").alias("n_words"), F.posexplode("w").alias("place", "term"))
    return cut.join(terms, "term", "left_semi")


def anchors(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """(term, phrase, offset, n, rank, apart, whole): the two rarest words of each window that occur in the corpus.
    ``apart`` is the distance to the first one where the second is the same word, ``whole`` whether all words occur."""
    each = windows.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    counted = each.join(frequency, "term", "left")
    by_window = Window.partitionBy("phrase")
    rarest_first = by_window.orderBy(F.col("count").asc_nulls_last(), "term", "offset")
    ranked = counted.withColumns(
        {
            "rank": F.row_number().over(rarest_first),
            "apart": F.when(F.lag("term").over(rarest_first) == F.col("term"), F.col("offset") - F.lag("offset").over(rarest_first)),
            "whole": ~F.max(F.col("count").isNull()).over(by_window),
        }
    )
    chosen = ranked.where((F.col("rank") <= 2) & F.col("count").isNotNull())
    return chosen.select("term", "phrase", "offset", "n", "rank", "apart", "whole")


def intersect(postings: DataFrame, chosen: DataFrame, slop: int) -> DataFrame:
    """(id, text_hash, phrase, n, begin, candidate): where the lists of a window's words agree up to ``slop`` words
    between the places that the two rarest words point to; ``candidate`` where the phrase may begin."""
    begin = F.col("place") - F.col("offset")
    found = postings.join(chosen, "term").select(
        "id", "text_hash", "phrase", "n", "rank", begin.alias("begin"), "n_words", "apart", "whole"
    )
    ordered = Window.partitionBy("id", "text_hash", "phrase").orderBy("begin")
    rarest = F.when(F.col("rank") == 1, F.col("begin"))
    near = found.withColumns(
        {
            "back": F.max(rarest).over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
            "ahead": F.min(rarest).over(ordered.rangeBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    # the same posting as first word; later ones are no nearer than the pair with both changed round
    itself = F.coalesce(F.col("ahead") == F.col("begin") + F.col("apart"), F.lit(False))
    ahead = F.when(~itself, F.col("ahead"))
    gap = F.when(F.col("n") == 1, F.lit(0)).otherwise(F.least(F.col("begin") - F.col("back"), ahead - F.col("begin")))
    looked_up = (F.col("rank") == 2) | (F.col("n") == 1)
    near = near.where(looked_up).withColumn("gap", gap).where(F.col("gap") <= slop)
    inside = (F.col("begin") >= 0) & (F.col("begin") + F.col("n") <= F.col("n_words"))
    candidate = (F.col("gap") == 0) & inside & F.col("whole")
    return near.select("id", "text_hash", "phrase", "n", "begin", candidate.alias("candidate"))


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id column, ``text_hash``, ``n_words``, ``n_hit`` (words inside phrase matches),
    ``items`` (sorted ids, as strings, of items with phrase matches) and ``near_windows`` (windows whose rarest words
    meet within ``slop``, at their own distance included, but never as the phrase)."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    owned = scratch.keep(item_windows(benchmark, window), "item_windows")
    windows = scratch.keep(owned.select("phrase", "n").distinct(), "windows")
    vocabulary = scratch.keep(windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct(), "vocabulary")
    terms = docs.select(F.explode(words(F.coalesce("text", F.lit("")))).alias("term"))
    frequency = scratch.keep(terms.join(vocabulary, "term", "left_semi").groupBy("term").count(), "frequency")
    chosen = scratch.keep(anchors(windows, frequency), "anchors")
    postings = scratch.keep(build_index(docs, chosen.select("term").distinct()), "postings")
    found = scratch.keep(intersect(postings, chosen, slop), "found")
    scratch.drop(postings)

    # each phrase candidate against the text; the words are cut once for each document
    candidate = F.struct("begin", "n", "phrase")
    lists = found.where("candidate").groupBy("id", "text_hash").agg(F.collect_set(candidate).alias("candidates"))
    lists = lists.withColumnsRenamed({"id": "c_id", "text_hash": "c_hash"})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("id", F.xxhash64(text).alias("text_hash"), count_words(F.col("text")).alias("n_words"), "text")
    same = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash"))
    own = lambda w, c: F.array_join(F.slice(w, c["begin"] + 1, c["n"]), " ")
    true = F.transform(F.array(words(text)), lambda w: F.filter("candidates", lambda c: own(w, c) == c["phrase"]))[0]
    joined = rows.join(lists, same, "left")
    checked = joined.select(
        "id", "text_hash", "n_words", F.when(F.col("candidates").isNotNull(), true).alias("hits")
    )
    checked = checked.select(
        "id", "text_hash", "n_words",
        F.size(F.array_distinct(F.flatten(F.transform("hits", lambda c: F.sequence(c["begin"], c["begin"] + c["n"] - 1))))).alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda c: c["phrase"])).alias("phrases"),
    )
    checked = scratch.keep(checked, "checked")

    hit = checked.select("id", "text_hash", F.explode("phrases").alias("phrase")).distinct()
    items = hit.join(owned, "phrase").groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    # every phrase of ``hits`` is among the windows found, so the others are what is left of their number
    met = found.select("id", "text_hash", "phrase").distinct().groupBy("id", "text_hash").agg(F.count("*").alias("met"))
    out = checked.select(
        "id", "text_hash", "n_words", F.coalesce(F.greatest("n_hit", F.lit(0)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.greatest(F.size("phrases"), F.lit(0)), F.lit(0)).alias("n_phrases"),
    )
    for more, name, default in ((items, "items", F.array().cast("array<string>")), (met, "met", F.lit(0).cast("long"))):
        more = more.withColumnsRenamed({"id": "m_id", "text_hash": "m_hash"})
        same = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
        out = out.join(more, same, "left").withColumn(name, F.coalesce(name, default)).drop("m_id", "m_hash")
    near = (F.col("met") - F.col("n_phrases")).alias("near_windows")
    return out.select(F.col("id").alias(id_col), "text_hash", "n_words", "n_hit", "items", near)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = 20) -> Column:
    """One word in ``share`` or more lies inside a benchmark window."""
    return (F.col(n_hit) > 0) & (share * F.col(n_hit) >= F.col(n_words))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = matches(docs, benchmark, window, 0, id_col, text_col).where(contaminated())
    bad = bad.select(F.col(id_col).alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    same = docs[id_col].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["_bad_hash"])
    return docs.join(bad, same, "left_anti")
