"""Conversations as training windows. DataFrame functions only.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside role and text every ``<|`` becomes ``<||``, so no
control string can arise there, and replacing ``<||`` by ``<|`` leads back; a line break or backslash in a role is
escaped with a backslash.

Prefix sums of turn tokens choose the windows: turn j, with p tokens of its conversation before it, is fresh in window
p / stride, rounded down. Windows are aligned to turns: a window holds the turns that begin inside its stride, whole.
Later windows open with the conversation's leading system turn and with a limited history: the last turns of the
window before whose tokens fit ``history``. Only fresh assistant texts are targets; repeated ones are masked. With
``stride = budget - history - system`` tokens a window stays within ``budget`` but for its last turn and an overlong
system turn; ``over_budget`` says so, no turn is ever cut or dropped.

A hot conversation is no hot task: prefix sums are made by slices of a conversation, whose totals (one row for each
slice) carry the offset; windows are bounded by the budget.

Defined cases: null text or role is empty; equal turn numbers are ordered by role and text; rows without conversation
id form a conversation of their own; null turn numbers come first; repeated rows are turns of their own; other columns
are ignored; no rows give no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Scripts without blanks between words, ideographs, their punctuation and pictures: South-East Asia, Tibet, East Asia.
UNSPACED = (
    r"\x{E00}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{1B00}-\x{1B7F}\x{2E80}-\x{A4CF}"
    r"\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FE30}-\x{FE4F}\x{FF00}-\x{FFEF}\x{16FE0}-\x{1B2FF}"
    r"\x{1F000}-\x{1FAFF}\x{20000}-\x{3FFFF}"
)
#: Words, numbers, single other signs and single characters of unspaced scripts. A token has 32 characters at most: longer
#: runs are several, also runs of blanks, of which fewer count nothing; so a text's length is bounded by its tokens.
TOKEN = (
    rf"[^\x00-\x40\x5B-\x60\x7B-\x7F{UNSPACED}]{{1,32}}|[0-9]{{1,32}}|[\x09-\x0D\x20]{{32}}"
    rf"|[^A-Za-z0-9\x09-\x0D\x20\x{{80}}-\x{{10FFFF}}]|[{UNSPACED}]"
)
#: Tokens that a turn costs beside its text.
TURN_TOKENS = 4
#: Turn numbers in a slice.
SLICE_TURNS = 512


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # a backslash pair is first set aside as a character pair that escape() never leaves behind
    role = F.replace(F.replace(role, F.lit("\\\\"), F.lit("<|b")), F.lit("\\n"), F.lit("\n"))
    return unescape(F.replace(role, F.lit("<|b"), F.lit("\\")))


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def prefix_sums(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, role, text, tokens) with ``place``, the turns before each in its conversation, and
    ``before``, their tokens: inside slices of turn numbers first, then over the slices' totals."""
    sliced = turns.withColumn("slice", F.floor(F.col("turn") / SLICE_TURNS))
    inside = Window.partitionBy("conv", "slice").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumns(
        {"own_place": F.count("*").over(inside), "own_before": F.coalesce(F.sum("tokens").over(inside), F.lit(0))}
    )
    totals = sliced.groupBy("conv", "slice").agg(F.count("*").alias("n"), F.sum("tokens").alias("total"))
    ahead = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("conv").alias("o_conv"), F.col("slice").alias("o_slice"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("o_place"),
        F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("o_before"),
    )
    same = F.col("conv").eqNullSafe(F.col("o_conv")) & F.col("slice").eqNullSafe(F.col("o_slice"))
    return own.join(offsets, same).select(
        "conv", "role", "text", "tokens", (F.col("own_place") + F.col("o_place")).alias("place"),
        (F.col("own_before") + F.col("o_before")).alias("before"),
    )


def windows(conversations: DataFrame, budget: int = 1024, history: int = 128, system: int = 64) -> DataFrame:
    """One row for each window: ``conv_id``, ``window``, ``formatted``, ``targets`` (begin and length of each target in
    code points), ``n_context`` (messages that repeat earlier ones), ``n_turns`` (fresh ones), ``tokens`` and
    ``over_budget``."""
    stride = budget - history - system
    if stride <= 0 or not 0 <= history <= stride:
        raise ValueError("budget must leave a stride that is not shorter than the history")
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
        (count_tokens(text) + TURN_TOKENS).cast("long").alias("tokens"),
    )
    placed = prefix_sums(turns).withColumn("window", F.floor(F.col("before") / stride))
    leading = (F.col("place") == 0) & (F.col("role") == "system")
    # the first fresh token of each window, and of the next one that has turns
    firsts = placed.groupBy("conv", "window").agg(F.min("before").alias("first"), F.sum("tokens").alias("fresh_tokens"))
    follow = Window.partitionBy("conv").orderBy("window")
    firsts = firsts.select(
        F.col("conv").alias("f_conv"), F.col("window").alias("f_window"),
        F.lead("window").over(follow).alias("next_window"), F.lead("first").over(follow).alias("next_first"),
    )
    known = placed.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("window") == F.col("f_window")))
    piece = F.concat(F.lit(BEGIN), _escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n"))
    repeats = (F.col("before") >= F.col("next_first") - history) & ~leading
    known = known.select(
        "conv", "place", "tokens", piece.alias("piece"), F.char_length(escape(F.col("text"))).alias("text_chars"),
        (F.col("role") == "assistant").alias("target"), leading.alias("leading"),
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.col("window").alias("window"), F.lit(2).alias("part")),
                    F.when(repeats, F.struct(F.col("next_window").alias("window"), F.lit(1).alias("part"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("use"),
    )
    used = known.select("*", "use.window", "use.part").drop("use")
    # the system turn goes into every later window: one row for each window
    opening = used.where("leading").select(F.col("conv").alias("s_conv"), *[F.col(c).alias(f"s_{c}") for c in ("piece", "text_chars", "tokens")])
    later = firsts.where("f_window > 0").join(opening, F.col("f_conv").eqNullSafe(F.col("s_conv")))
    later = later.select(
        F.col("f_conv").alias("conv"), F.lit(0).cast("long").alias("place"), F.col("s_tokens").alias("tokens"),
        F.col("s_piece").alias("piece"), F.col("s_text_chars").alias("text_chars"), F.lit(False).alias("target"),
        F.lit(True).alias("leading"), F.col("f_window").alias("window"), F.lit(0).alias("part"),
    )
    message = F.struct("part", "place", "piece", "text_chars", "target", "tokens")
    grouped = used.unionByName(later).groupBy("conv", "window").agg(F.array_sort(F.collect_list(message)).alias("m"))
    tail = len(END) + 1
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,chars:int>>").alias("spans"))

    def step(s, x):
        after = s["at"] + F.char_length(x["piece"])
        span = F.struct((after - tail - x["text_chars"]).alias("begin"), x["text_chars"].alias("chars"))
        fresh = (x["part"] == 2) & x["target"]
        return F.struct(after.alias("at"), F.when(fresh, F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    tokens = F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])
    return grouped.select(
        F.col("conv").alias("conv_id"), "window",
        F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
        F.aggregate("m", state, step, lambda s: s["spans"]).alias("targets"),
        F.size(F.filter("m", lambda x: x["part"] < 2)).alias("n_context"),
        F.size(F.filter("m", lambda x: x["part"] == 2)).alias("n_turns"),
        tokens.alias("tokens"), (tokens > budget).alias("over_budget"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, the fresh (role, text) of each window read back from its string, and ``losses``,
    the unescaped texts under its mask."""
    messages = F.slice(F.split("formatted", r"<\|im_end\|>\n", -1), F.col("n_context") + 1, F.col("n_turns"))

    def read(x):
        body = F.substring(x, F.lit(len(BEGIN) + 1), F.char_length(x))
        cut = F.locate("\n", body)
        return F.struct(
            _unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(body, cut + 1, F.char_length(body))).alias("text"),
        )

    loss = F.transform("targets", lambda t: unescape(F.substring("formatted", t["begin"] + 1, t["chars"])))
    return formatted.withColumns({"turns": F.transform(messages, read), "losses": loss})


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them. A digest needs its conversation in one row:
    this reading, unlike the windows, is bounded by the longest conversation."""
    said = lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    rows = read_turns(formatted).select(
        "conv_id", "window", F.array_join(F.transform("turns", said), "").alias("turns"),
        F.array_join("losses", "").alias("loss"), "n_turns", F.char_length("formatted").alias("chars"),
    )
    by_conversation = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
        F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
    )
    joined = by_conversation.withColumns(
        {c: F.array_join(F.transform("w", lambda x: x[c]), "") for c in ("turns", "loss")}  # noqa: B023
    )
    return joined.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
