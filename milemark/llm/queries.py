"""The operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from milemark.llm import byte_bpe, chat_windows, compression, decontamination, histogram_shards, host_quality, language_id, license_scan, line_dedup, prefix_trie, simhash, term_pipeline, toxicity
from milemark.llm.registry import query, table

#: Score from which a text counts as toxic.
THRESHOLD = 0.3
#: Score from which a text counts as good.
GOOD = 0.7
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def held_out(n: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder`` modulo ``n``; false without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n == remainder, F.lit(False))


_RULE_ROWS = " UNION ALL ".join(
    f"SELECT source AS host, '{name}' AS rule, count(*)::double AS n, (count(*) FILTER ({rule}))::double AS f "
    "FROM measured WHERE source IS NOT NULL GROUP BY source"
    for name, rule in host_quality.RULES.items()
)


@query(
    "op1_quality_rules",
    rf"""
    WITH cut AS (
      SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(w[i + 1 : i + 8], ' ') AS words
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 7, 0))) AS i FROM cut)),
    covered AS (
      SELECT doc_id, count(DISTINCT spot) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS spot
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, words) AS times FROM windows) WHERE times > 1) GROUP BY doc_id),
    lines AS (
      SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM cut)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    measured AS (
      SELECT doc_id, source, len(w)::bigint AS n_words, length(array_to_string(w, ''))::bigint AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
        coalesce(lines.n, 0)::bigint AS n_dup_lines, coalesce(covered.n, 0)::bigint AS n_repeat_words
      FROM cut LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    counted AS ({_RULE_ROWS}),
    moments AS (
      SELECT rule, m, CASE WHEN hosts > 1 AND m > 0 AND m < 1 THEN
          greatest((weighted - docs * m * m - (hosts - 1) * m * (1 - m)) / (docs - squares / docs), 0) ELSE 0 END AS v
      FROM (SELECT rule, count(*) AS hosts, sum(n) AS docs, sum(f) / sum(n) AS m, sum(n * n) AS squares,
              sum(f * f / n) AS weighted FROM counted GROUP BY rule)),
    hosts AS (
      SELECT host, max(CASE WHEN v <= 0 THEN m ELSE (f + s * m) / (n + s) END) AS rate
      FROM (SELECT *, greatest(m * (1 - m) / nullif(v, 0) - 1, 2) AS s FROM counted JOIN moments USING (rule)) GROUP BY host)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 6) AS host_rate,
      coalesce(rate > 0.5, false) AS host_rejected, NOT base_failed AND NOT coalesce(rate > 0.5, false) AS kept
    FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
      LEFT JOIN hosts ON source = host
    """,
)
def op1(spark, sf):
    return host_quality.judge(table(spark, sf, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def toxicity_model(docs, labels):
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return toxicity.train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), train)


@query("op2_toxicity")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@query("op6_language_id")
def op6(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.train(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


@query(
    "op7_decontamination",
    r"""
    WITH docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i + 1 : i + least(len(w), 13)], ' ') AS phrase
      FROM (SELECT *, unnest(range(greatest(len(w) - 13, 0) + 1)) AS i FROM items WHERE len(w) > 0)),
    places AS (
      SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS phrase
      FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM windows)
            WHERE len(w) >= n)),
    found AS (SELECT DISTINCT doc_id, i, n, p.phrase FROM places p SEMI JOIN windows USING (n, phrase)),
    hits AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM found) GROUP BY doc_id),
    owned AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM found JOIN windows USING (n, phrase)) GROUP BY doc_id)
    SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owned USING (doc_id)
    """,
)
def op7(spark, sf):
    found = decontamination.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontamination.contaminated().alias("contaminated"),
    )


#: A conversation whose texts hold the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op8_chat_formatting",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
    sized AS (
      SELECT *, len(regexp_extract_all(text, '{chat_windows.TOKEN}')) + 4 AS tokens,
        12 + length(replace(replace(replace(role, '<|', '<||'), '\', '\\'), chr(10), '\n')) + 1
          + length(replace(text, '<|', '<||')) + 11 AS chars
      FROM turns),
    placed AS (
      SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
      FROM sized),
    windowed AS (SELECT *, before // 832 AS w, place = 1 AND role = 'system' AS is_head FROM placed),
    firsts AS (
      SELECT conv_id, w, lead(first) OVER (PARTITION BY conv_id ORDER BY w) AS next_first
      FROM (SELECT conv_id, w, min(before) AS first FROM windowed GROUP BY conv_id, w)),
    sums AS (
      SELECT t.conv_id,
        sum(chars) + coalesce(sum(chars) FILTER (before >= next_first - 128 AND NOT is_head), 0)
          + coalesce(max(chars) FILTER (is_head), 0) * (count(DISTINCT t.w) - 1) AS formatted_chars
      FROM windowed t JOIN firsts f ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.w = f.w GROUP BY t.conv_id)
    SELECT t.conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
      any_value(s.formatted_chars)::bigint AS formatted_chars
    FROM windowed t JOIN sums s ON t.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY t.conv_id
    """,
)
def op8(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    return chat_windows.digests(chat_windows.windows(rows.unionByName(own), budget=1024, history=128, system=64))


@query("op9_license_scan")
def op9(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"), license_scan.NOTICES)


@query("op10_byte_level_bpe")
def op10(spark, sf):
    tokens = byte_bpe.encode(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(tokens, RANKS).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op3_line_dedup",
    """
    WITH cut AS (
      SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
    keyed AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
    repeated AS (
      SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    marked AS (
      SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op3(spark, sf):
    kept = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_sharding")
def op4(spark, sf):
    placed = histogram_shards.shard(table(spark, sf, "documents").select("doc_id", "text"), n_shards=24)
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_simhash_near_dedup")
def op5(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.format_string("%016x", "fingerprint").alias("fingerprint"), "component_id")


def quality_model(docs, labels):
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return compression.train(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), train)


@query("op11_quality_classifier")
def op11(spark, sf):
    docs = table(spark, sf, "documents")
    scored = compression.score(docs, quality_model(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


#: Lower-case words of a text, in the checking engine.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    term_pipeline.UPPER, term_pipeline.LOWER
)


@query(
    "op13_ranked_search",
    f"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
    kept AS (SELECT r, doc_id, len(w) AS n, w FROM texts WHERE len(w) > 0),
    wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    counts AS (
      SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM kept)
      WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
    sums AS (SELECT count(*) AS n_docs, sum(n)::bigint AS n_terms FROM kept),
    weights AS (
      SELECT term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint AS weight
      FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), sums),
    lengths AS (SELECT r, doc_id, 50 + (50 * n * n_docs) // n_terms AS m FROM kept, sums),
    scored AS (
      SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint AS score
      FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (r) GROUP BY item_id, r, doc_id)
    SELECT item_id, rank::int AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
      FROM scored WHERE score > 0)
    WHERE rank <= 50
    """,
)
def op13(spark, sf):
    return term_pipeline.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), top=50)


#: Unsigned crc32 of a conversation's decimal id, in the checking engine: one step for each bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''),
    lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""


@query(
    "op12_prefix_trie",
    f"""
    WITH sized AS (
      SELECT conv_id AS c, turn, length(coalesce(text, '')) AS chars,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
      FROM conversations WHERE conv_id IS NOT NULL),
    turns AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS place FROM sized),
    convs AS (SELECT c, n, c - c % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT c, count(*) AS n FROM turns GROUP BY c)),
    rebuilt AS (
      SELECT k.c, t.place, digest, chars FROM convs k JOIN turns t ON t.c = k.base AND t.place <= k.h
      UNION ALL
      SELECT k.c, t.place - k.h + least(k.h, coalesce(b.n, 0)), digest, chars
      FROM convs k JOIN turns t ON t.c = k.c AND t.place > k.h LEFT JOIN convs b ON b.c = k.base),
    paths AS (
      SELECT c, place AS depth, chars, sha256(string_agg(digest, '') OVER (PARTITION BY c ORDER BY place)) AS name FROM rebuilt
      UNION ALL SELECT c, 0, 0, '' FROM convs),
    linked AS (SELECT *, lag(name) OVER (PARTITION BY c ORDER BY depth) AS parent FROM paths),
    nodes AS (
      SELECT name, min(parent) AS parent, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars
      FROM linked GROUP BY name),
    kids AS (SELECT parent AS name, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
    own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (name)),
    totals AS (
      SELECT p.name, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * o.chars) AS saved_tokens
      FROM own o JOIN paths p ON p.c = o.conv_id AND p.depth <= o.depth GROUP BY p.name),
    ends AS (
      SELECT name, string_agg(c::varchar, ',' ORDER BY c) AS ids
      FROM (SELECT c, arg_max(name, depth) AS name FROM paths GROUP BY c) GROUP BY name)
    SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens::bigint AS saved_tokens,
      sha256(coalesce(ids, '')) AS ends_sha256
    FROM own o JOIN totals USING (name) LEFT JOIN ends USING (name) LEFT JOIN own p ON o.parent = p.name
    """,
)
def op12(spark, sf):
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))
