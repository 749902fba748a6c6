"""Quality rules with host verdicts.

Each text is measured and judged by rules of its own. Failures are then counted by host and rule, each rate is shrunk
towards the rate of all hosts with a beta prior fitted to the hosts (method of moments of the beta-binomial), and a
host whose shrunk rate of any rule is above ``max_rate`` is rejected with all its documents. A host of few documents
is thus judged mostly by the corpus, a large one by itself.

Only counts by host and rule are shuffled, pre-aggregated; verdicts are joined back to the narrow measures, where
Spark broadcasts them if they are small and splits a hot host otherwise.

Defined cases: null and blank texts have no words; a null host is no host, so its documents are judged alone; repeated
rows each count; without documents the result is empty; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.llm.batches import Scratch, text_slices

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Rules on a single text, by name; a text that breaks one of the first two is rejected whatever its host.
RULES: dict[str, Column | str] = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines > 0 and 10 * n_dup_lines > n_words",
}
BASE = ("short", "repeats")


def _repeated(ids: np.ndarray, owners: np.ndarray, window: int) -> np.ndarray:
    """Flags of the words inside a window of words that its own text holds twice or more.

    Windows are named by doubling: the name of 2k words is that of the pair of names of k words.
    """
    n = len(ids)
    covered = np.zeros(n, bool)
    if n < window:
        return covered
    names, span = ids.astype(np.int64), 1
    while span < window:
        step = min(span, window - span)
        pairs = names[: len(names) - step] * (int(names.max()) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1]
        span += step
    begins = np.arange(len(names))
    whole = owners[begins] == owners[begins + window - 1]
    begins, names = begins[whole], names[whole]
    if not len(names):
        return covered
    own = np.unique(names * (int(owners[-1]) + 1) + owners[begins], return_inverse=True, return_counts=True)
    twice = begins[own[2][own[1]] > 1]
    change = np.bincount(twice, minlength=n + 1) - np.bincount(twice + window, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def _measured(texts: list[str | None], window: int) -> dict[str, np.ndarray]:
    out = {m: np.zeros(len(texts), np.int64) for m in MEASURES}
    names: dict[bytes, int] = {}
    ids: list[int] = []
    for i, text in enumerate(texts):
        data = (text or "").encode()
        words = data.split()
        out["n_words"][i] = len(words)
        joined = np.frombuffer(b"".join(words), np.uint8)
        out["word_chars"][i] = np.count_nonzero((joined & 0xC0) != 0x80)
        out["n_symbols"][i] = sum(map(data.count, (bytes([s]) for s in SYMBOLS)))
        lines = [line for line in data.split(b"\n") if line and not line.isspace()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        ids.extend([names.setdefault(w, len(names)) for w in words])
    owners = np.repeat(np.arange(len(texts)), out["n_words"])
    covered = _repeated(np.array(ids, np.int64), owners, window)
    out["n_repeat_words"] = np.bincount(owners, covered, len(texts)).astype(np.int64)
    return out


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", window: int = WINDOW
) -> DataFrame:
    """The id column, ``host`` and the measures of each whole text."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = _measured(part.column("_text").to_pylist(), window)
                columns = [part.column("_id"), part.column("_host"), *(pa.array(found[m]) for m in MEASURES)]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "host", *MEASURES])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("host", T.StringType())])
    for m in MEASURES:
        schema.add(m, T.LongType())
    columns = F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"), F.col(text_col).alias("_text")
    return docs.select(*columns).mapInArrow(run, schema)


def host_rates(measures: DataFrame, rules: dict[str, str] = RULES, least_strength: float = 2.0) -> DataFrame:
    """By host and rule: documents ``n``, ``failures`` and the ``shrunk`` rate under the fitted beta prior.

    With K hosts, N documents, overall rate m and between-host variance v by moments, the prior has the strength
    s = m (1 - m) / v - 1, ``least_strength`` at least, and the shrunk rate is (failures + s m) / (n + s); without
    excess variance it is m.
    """
    counts = measures.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()]
    )
    # by rule: host counts in long form, and their totals as one row for each rule
    stacked = ", ".join(f"'{name}', `{name}`" for name in rules)
    long = counts.selectExpr("host", "n", f"stack({len(rules)}, {stacked}) as (rule, failures)")
    n, f = F.col("n").cast("double"), F.col("failures").cast("double")
    total = long.groupBy("rule").agg(
        F.count("*").alias("hosts"), F.sum(n).alias("docs"), F.sum(f).alias("failed"),
        F.sum(n * n).alias("squares"), F.sum(f * f / n).alias("weighted"),
    )
    total = total.selectExpr("rule", "hosts", "docs", "squares", "weighted", "failed / docs as m").selectExpr(
        "rule", "m",
        """case when hosts > 1 and m > 0 and m < 1 then
             greatest((weighted - docs * m * m - (hosts - 1) * m * (1 - m)) / (docs - squares / docs), 0D)
           else 0D end as v""",
    )
    strength = f"greatest(m * (1 - m) / v - 1, {least_strength}D)"
    # one row for each rule
    return long.join(F.broadcast(total), "rule").selectExpr(
        "host", "rule", "n", "failures",
        f"case when v <= 0 then m else (failures + {strength} * m) / (n + {strength}) end as shrunk",
    )


def judge(
    docs: DataFrame, max_rate: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """One row per document: the id column, the measures, ``base_failed``, ``host_rate`` (the host's worst shrunk
    rate), ``host_rejected`` and ``kept``."""
    scratch = Scratch(docs.sparkSession)
    measures = scratch.keep(measure(docs, id_col, text_col, host_col), "measures")
    # written, so that its size is known: few hosts are broadcast, else a hot host's rows are split by the join
    worst = scratch.keep(host_rates(measures).groupBy("host").agg(F.max("shrunk").alias("host_rate")), "hosts")
    failed = F.expr(" or ".join(f"({RULES[rule]})" for rule in BASE))
    rejected = F.coalesce(F.col("host_rate") > max_rate, F.lit(False))
    judged = measures.join(worst, "host", "left").withColumns({"base_failed": failed, "host_rejected": rejected})
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("host")
