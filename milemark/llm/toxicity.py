"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts of the training rows are unlabelled: toxic ones may hide among
them. With the class prior p, the risk p R+(toxic) + max(0, R-(unlabelled) - p R-(toxic)) corrects for them; a batch
whose corrected part falls below zero takes its step upwards instead. A few linear classifiers in numpy, each on its
own two thirds of the sample, are averaged.

Features are words and beginnings of words of a text, present or not. Those that are clearly more frequent in toxic
than in unlabelled texts of the sample are chosen, at most ``max_features`` of them; of a word and its beginnings only
the clearest.

The classifiers are fitted on a bounded sample: at most ``max_toxic`` toxic and ``max_unlabelled`` other training
texts, the ones with the smallest hash of their id, equal texts once. Their size does not depend on the table, so the
model (at most ``max_features`` words and as many weights for each classifier) may be sent to every executor. Every
text is scored, whole.

Defined cases: null and empty texts have no features, so they get the score of the bias; rows without an id are scored
but not learned from; several labels of one id count as toxic if one is; where labels name toxic texts alone, their
share among all texts is estimated; without any toxic training text, or without a sign that tells them apart, all scores
are the prior (0 where nothing is known); repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.llm.batches import Scratch, text_slices
from milemark.llm.samples import smallest_hashes

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
CLASSIFIERS = 3


def _spellings(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def text_features(text: str | None) -> set[str]:
    return {s for word in set(WORD.findall((text or "").lower())) for s in _spellings(word)}


def _sample(docs: DataFrame, labels: DataFrame, train, max_toxic: int, max_unlabelled: int) -> tuple[DataFrame, float | None]:
    """(text, toxic) of the sample, and the share of toxic among the labelled training rows; None if no row is labelled
    as clean, since confirmed texts alone say nothing about their share."""
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.where(F.coalesce(train, F.lit(False))).select("doc_id").distinct().join(known, "doc_id", "left")
    is_toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    ids = ids.select("doc_id", is_toxic.alias("toxic"), F.col("toxic").isNotNull().alias("labelled"))
    n = ids.agg(F.count_if("toxic").alias("toxic"), F.count_if("labelled").alias("labelled"), F.count("*").alias("all")).first()
    toxic = smallest_hashes(ids.where("toxic"), max_toxic, n.toxic)
    others = smallest_hashes(ids.where("not toxic"), max_unlabelled, n.all - n.toxic)
    chosen = toxic.unionByName(others).select("doc_id", "toxic")
    # bounded by the two limits
    texts = docs.join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    prior = n.toxic / n.labelled if n.labelled > n.toxic else 0.0 if not n.toxic else None
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic")), prior


def estimate_prior(toxic: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.3) -> float:
    """The share of toxic texts among unlabelled ones, from how many signs each text has.

    Unlabelled texts are toxic ones and others, so of any kind of text they have at least the share times as many as
    the toxic ones have. The smallest such ratio bounds the share, and comes near it where other texts of that kind are
    rare; kinds are "so many signs at least", as long as ``least_share`` of the toxic texts have them.
    """
    ratios = [1.0]
    for least in range(1, int(toxic.max(initial=0)) + 1):
        held = (toxic >= least).mean()
        if held < least_share:
            break
        ratios.append((unlabelled >= least).mean() / held)
    return float(np.clip(min(ratios), 1 / (len(unlabelled) + 2), 0.5))


def _choose(sample: DataFrame, max_features: int, least: int = 3, z: float = 4.5, ratio: float = 3.0) -> list[str]:
    """Features with a significant surplus in toxic texts, the most significant first."""

    def count(batches):
        for batch in batches:
            for part in text_slices(batch):
                seen = {True: Counter(), False: Counter()}
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    seen[toxic].update(text_features(text))
                names = list(seen[True].keys() | seen[False].keys())
                counts = [pa.array([seen[k][f] for f in names], pa.int64()) for k in (True, False)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["feature", "a", "b"])

    n = sample.groupBy().agg(F.count_if("toxic").alias("n1"), F.count_if(~F.col("toxic")).alias("n0")).first()
    if not n.n1 or not n.n0:
        return []
    counts = sample.mapInArrow(count, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    p1, p0 = F.col("a") / n.n1, F.col("b") / n.n0
    pooled = (F.col("a") + F.col("b")) / (n.n1 + n.n0)
    score = (p1 - p0) / F.sqrt(pooled * (1 - pooled) * (1 / n.n1 + 1 / n.n0) + 1e-12)
    best = counts.where(F.col("a") >= least).withColumn("z", score).where((F.col("z") > z) & (p1 > ratio * p0))
    return _without_kin([row.feature for row in best.orderBy(F.desc("z"), "feature").limit(max_features).collect()])


def _without_kin(features: list[str]) -> list[str]:
    """Of features where one begins with the other, the first alone: a rare word and its beginnings are one sign."""
    kept: list[str] = []
    stems: set[str] = set()
    beginnings: set[str] = set()
    for feature in features:
        stem = feature.rstrip("*")
        own = {stem[:k] for k in range(1, len(stem) + 1)}
        # an exact word and the longer words that begin with it have no text's word in common
        apart = feature.endswith("*") and stem in kept and not (own - {stem}) & stems
        if apart or (stem not in beginnings and not own & stems):
            kept.append(feature)
            stems.add(stem)
            beginnings |= own
    return kept


def _present(texts: list[str | None], place: dict[str, int]) -> list[list[int]]:
    out = []
    for text in texts:
        words = set(WORD.findall((text or "").lower()))
        out.append(sorted({j for w in words for s in _spellings(w) if (j := place.get(s)) is not None}))
    return out


def negative_risk(w: np.ndarray, xp: np.ndarray, xu: np.ndarray, prior: float) -> float:
    """The corrected risk of the other class: logistic loss of the unlabelled rows less the toxic ones' part."""
    return float(np.logaddexp(0, xu @ w).mean() - prior * np.logaddexp(0, xp @ w).mean())


def step_direction(w: np.ndarray, xp: np.ndarray, xu: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the whole risk, or where the corrected part is below zero that of its opposite, which lifts it."""
    sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (xp, xu))
    if negative_risk(w, xp, xu, prior) >= 0:
        gp, gu = np.full(len(sp), -prior / len(sp)), su / len(su)
    else:
        gp, gu = prior * sp / len(sp), -su / len(su)
    return xp.T @ gp + xu.T @ gu


def fit_nnpu(
    toxic: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float, seed: int,
    epochs: int = 60, batch: int = 400, rate: float = 0.02, decay: float = 1e-4,
) -> np.ndarray:
    """Weights, the bias last, of a linear classifier under the non-negative risk with logistic loss (Adam steps)."""

    def dense(rows):
        x = np.zeros((len(rows), n_features + 1), np.float32)
        x[:, -1] = 1
        for i, row in enumerate(rows):
            x[i, row] = 1
        return x

    rng = np.random.default_rng(seed)
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    regular = np.r_[np.full(n_features, decay), 0]
    batches = max(1, len(unlabelled) // batch)
    for _ in range(epochs):
        order, others = rng.permutation(len(toxic)), rng.permutation(len(unlabelled))
        few = len(toxic) < 8 * batches
        for k, part in enumerate(np.array_split(others, batches)):
            xp = dense([toxic[i] for i in (order if few else np.array_split(order, batches)[k])])
            xu = dense([unlabelled[i] for i in part])
            g = step_direction(w, xp, xu, prior) + regular * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


class Model:
    """Chosen features and the classifiers' weights; without classifiers every score is the prior."""

    def __init__(self, features: list[str], weights: np.ndarray, prior: float):
        self.place = {f: i for i, f in enumerate(features)}
        self.weights, self.prior = weights, prior

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.prior)
        rows = _present(texts, self.place)
        z = np.array([self.weights[:, row].sum(axis=1) + self.weights[:, -1] for row in rows]).reshape(len(rows), -1)
        return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).mean(axis=1)


def train(
    docs: DataFrame, labels: DataFrame, train_rows, max_toxic: int = 6000, max_unlabelled: int = 12000,
    max_features: int = 4096, prior: float | None = None,
) -> Model:
    """Fit on (doc_id, text) with labels (doc_id, toxic) of the rows where ``train_rows`` holds. Without ``prior`` the
    share of toxic texts is that among the labelled rows, or estimated if all of those are toxic."""
    scratch = Scratch(docs.sparkSession)
    sample, seen = _sample(docs, labels, train_rows, max_toxic, max_unlabelled)
    sample = scratch.keep(sample.repartition(16), "toxic_sample")
    features = _choose(sample, max_features)
    place = {f: i for i, f in enumerate(features)}

    def present(batches):
        for batch in batches:
            for part in text_slices(batch):
                rows = pa.array(_present(part.column("text").to_pylist(), place), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), part.column("part"), rows], ["toxic", "part", "features"])

    if prior is None:
        prior = seen
    if not features or (prior is not None and not 0 < prior < 1):
        scratch.drop(sample)
        return Model([], np.zeros((0, 1)), 0.0 if prior is None else prior)
    parts = sample.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(CLASSIFIERS)).cast("int"))
    vectors = parts.mapInArrow(present, "toxic boolean, part int, features array<int>")
    if prior is None:
        # as many numbers as the sample has distinct counts of signs, of which there are few
        vectors = scratch.keep(vectors, "toxic_vectors")
        signs = vectors.groupBy("toxic", F.size("features").alias("n")).count().collect()
        counts = [np.repeat([r.n for r in signs if r.toxic == k], [r["count"] for r in signs if r.toxic == k]).astype(int) for k in (True, False)]
        prior = estimate_prior(*counts)
    # classifier k learns from the rows of all parts but its own
    bagged = vectors.select("*", F.explode(F.array(*map(F.lit, range(CLASSIFIERS)))).alias("k")).where("part <> k")

    def fit(key, rows):
        rows = rows.sort_values(["toxic", "features"], key=lambda c: c.map(tuple) if c.name == "features" else c)
        groups = [[list(x) for x in rows.features[rows.toxic == flag]] for flag in (True, False)]
        weights = fit_nnpu(*groups, len(features), prior, seed=int(key[0])) if all(groups) else np.zeros(0)
        return rows.head(1)[[]].assign(weights=[weights.tolist()])

    fitted = bagged.groupBy("k").applyInPandas(fit, "weights array<double>").collect()
    scratch.drop(sample)
    weights = sorted(row.weights for row in fitted if row.weights)
    return Model(features, np.array(weights).reshape(len(weights), len(features) + 1), prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``score``, 0 to 1, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = pa.array(shared.value.score(part.column("_text").to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("_id"), found], [id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more; equal columns, in one pass and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                yield part.filter(pa.array(shared.value.score(part.column("text").to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)
