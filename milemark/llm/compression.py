"""Quality by compression: zstandard dictionaries of good and of bad text.

A text like the good ones compresses better with a dictionary cut from good texts, and the reverse. Each whole text is
compressed in pieces of ``PIECE`` bytes, each by itself, with both dictionaries, so that what a long text learns of
itself does not drown what the dictionaries know. The difference of the two compressed sizes by byte of text is the
measure; a logistic curve, fitted to labelled texts that no dictionary has seen, turns it into the chance of label 1.

Dictionaries and curve are fitted on a bounded sample: at most ``most_each`` labelled texts of each class (smallest
hash of the id, equal texts once); of each, at most ``PIECES`` pieces evenly spread over the whole text go into its
dictionary. Two thirds of the texts make the dictionaries, one third the curve, where each class weighs as much as it
has labelled rows. The model is two dictionaries of at most ``dictionary_bytes`` and three numbers, so it may be sent
to every executor. Every text is scored, whole.

Defined cases: null and empty texts have difference 0 and get its score; rows without an id are scored but not learned
from, labels that are null, or differ for one id, teach nothing; where one class is missing, or too small for a
dictionary, every score is the share of label 1 among the labelled training rows (0.5 where nothing is known); repeated
rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.llm.batches import Scratch, text_slices
from milemark.llm.samples import agreed, smallest_hashes

#: Bytes compressed at a time, and bytes of a dictionary's sample.
PIECE, SAMPLE_PIECE = 512, 256
#: Pieces of one text in a dictionary's sample.
PIECES = 32
LEVEL = 1


def sample_pieces(data: bytes) -> list[bytes]:
    """At most ``PIECES`` pieces, evenly spread over the whole text."""
    n = -(-len(data) // SAMPLE_PIECE)
    step = max(1, -(-n // PIECES))
    return [data[i * SAMPLE_PIECE : (i + 1) * SAMPLE_PIECE] for i in range(0, n, step)]


def build_dictionary(pieces: list[bytes], dictionary_bytes: int) -> bytes:
    """A dictionary of the distinct pieces; empty where they are too few to make one."""
    try:
        return zstandard.train_dictionary(dictionary_bytes, sorted(set(pieces))).as_bytes()
    except zstandard.ZstdError:
        return b""


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of the weighted logistic regression of y on x, by damped Newton steps."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    hold = np.diag([ridge * weight.sum(), 1e-9])

    def loss(w):
        z = a @ w
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + w @ hold @ w / 2

    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (weight * (p - y)) + hold @ w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + hold + 1e-9 * np.eye(2)
        move, length = np.linalg.solve(curve, slope), 1.0
        while length > 1e-6 and loss(w - length * move) > loss(w):
            length /= 2
        w = w - length * move
        if np.abs(length * move).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


class Model:
    """Two dictionaries and the curve; without dictionaries every score is ``prior``."""

    def __init__(self, good: bytes, bad: bytes, prior: float, scale: float = 1.0, slope: float = 0.0, intercept: float = 0.0):
        self.good, self.bad, self.prior = good, bad, prior
        self.scale, self.slope, self.intercept = scale, slope, intercept
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def _compressors(self):
        if self._pair is None:
            made = []
            for data in (self.good, self.bad):
                known = zstandard.ZstdCompressionDict(data)
                known.precompute_compress(level=LEVEL)
                made.append(
                    zstandard.ZstdCompressor(LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
                )
            self._pair = made
        return self._pair

    def difference(self, data: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, by byte of text."""
        if not data:
            return 0.0
        good, bad = self._compressors()
        saved = 0
        for begin in range(0, len(data), PIECE):
            piece = data[begin : begin + PIECE]
            saved += len(bad.compress(piece)) - len(good.compress(piece))
        return saved / len(data)

    def scores(self, differences: np.ndarray) -> np.ndarray:
        if not (self.good and self.bad):
            return np.full(len(differences), self.prior)
        z = self.slope * np.asarray(differences, float) / self.scale + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _sample(docs: DataFrame, labels: DataFrame, train: Column, most_each: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, quality, part) of the sample, and the number of labelled training rows of each class."""
    known = agreed(labels, "quality", train)
    totals = {int(row.quality): row["count"] for row in known.where("quality in (0, 1)").groupBy("quality").count().collect()}
    picked = [smallest_hashes(known.where(F.col("quality") == q), most_each, totals.get(q, 0)) for q in (0, 1)]
    # bounded by twice most_each
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.join(chosen, "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("quality").cast("int").alias("quality"))
    once = rows.groupBy("text").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most")
    return once.select("text", "quality", F.pmod(F.xxhash64("text"), F.lit(3)).cast("int").alias("part")), totals


def train(docs: DataFrame, labels: DataFrame, train_rows: Column, most_each: int = 4000, dictionary_bytes: int = 112_640) -> Model:
    """Fit on (doc_id, text) with labels (doc_id, quality) of the labels where ``train_rows`` holds."""
    scratch = Scratch(docs.sparkSession)
    sample, totals = _sample(docs, labels, train_rows, most_each)
    sample = scratch.keep(sample.repartition(16), "quality_sample")
    count = sum(totals.values())
    prior = totals.get(1, 0) / count if count else 0.5

    def cut(batches):
        for batch in batches:
            for part in text_slices(batch):
                found = [(q, p) for data, q in zip(_bytes(part.column("text")), part.column("quality").to_pylist()) for p in sample_pieces(data)]
                columns = [pa.array([q for q, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["quality", "piece"])

    def build(table: pa.Table) -> pa.Table:
        made = build_dictionary(table.column("piece").to_pylist(), dictionary_bytes)
        return pa.table({"quality": pa.array([table.column("quality")[0].as_py()], pa.int32()), "made": pa.array([made], pa.binary())})

    # at most most_each * PIECES pieces of SAMPLE_PIECE bytes in a group
    pieces = sample.where("part < 2").mapInArrow(cut, "quality int, piece binary")
    made = {row.quality: bytes(row.made) for row in pieces.groupBy("quality").applyInArrow(build, "quality int, made binary").collect()}
    model = Model(made.get(1, b""), made.get(0, b""), prior)
    if model.good and model.bad:

        def measure(batches):
            for batch in batches:
                for part in text_slices(batch):
                    found = [model.difference(data) for data in _bytes(part.column("text"))]
                    yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(found, pa.float64())], ["quality", "x"])

        rows = sample.where("part = 2").mapInArrow(measure, "quality int, x double").collect()
        rows.sort(key=lambda row: (row.x, row.quality))
        x, y = np.array([row.x for row in rows]), np.array([float(row.quality) for row in rows])
        if 0 < y.sum() < len(y):
            share = {q: totals[q] / count / (y == q).sum() for q in (0, 1)}
            weight = np.where(y == 1, share[1], share[0]) * len(y)
            model.scale = float(np.abs(x).mean()) or 1.0
            model.slope, model.intercept = fit_curve(x / model.scale, y, weight)
        else:
            model = Model(b"", b"", prior)
    scratch.drop(sample)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``difference`` and ``score`` (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in text_slices(batch, "_text"):
                texts = _bytes(part.column("_text"))
                x = np.array([known.difference(data) if known.good and known.bad else 0.0 for data in texts])
                columns = [part.column("_id"), pa.array(x, pa.float64()), pa.array(known.scores(x), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "difference", "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema.add("difference", T.DoubleType()).add("score", T.DoubleType())
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)
