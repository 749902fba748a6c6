"""Sharding by histogram sort: splitters found by counting, then one exchange.

Documents are ordered by a 63-bit key: hash bits of the text above hash bits of the id. Equal texts so lie together,
and yet a group of copies as large as a third of the table can be cut anywhere. The driver holds probes, candidate
borders in key space. In every round all partitions count the exact bytes and rows below each probe; where the byte
position wanted for a splitter is not met within the tolerance, new probes are placed inside the interval that holds
it, most of them close to where its bytes would lie if they were even. Rounds end when every splitter is within its
tolerance or its interval is one key wide. Then each document goes to its place once.

Each shard is cut into pieces by further splitters, as many as the bytes or the rows need, whichever are more, so that
positions inside a shard come from a sort of a piece and the exact rows before it; no task sees a shard. Pieces of equal
bytes that hold too many rows (empty or short texts that lie together) are cut again at splitters of the rows. Driver and
tasks hold numbers by piece (about 2 rows / ``rows_per_piece`` and bytes / ``bytes_per_piece`` at most), never by document.

A border of shards that cuts a group of equal texts moves to the nearer end of the group, if that is within half the
tolerance of a shard, so that shards stay within the whole; a larger group is cut where the bytes want it.

Defined cases: null text has no bytes but the 8 of its row; a null id hashes like 0; rows equal in id and text share
one key, cannot be cut apart and are ordered among themselves by nothing that would show; fewer rows than shards
leave shards empty; an empty table gives no rows; columns named ``size``, ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milemark.llm.batches import Scratch

#: Bytes that a row counts beside its text.
ROW_BYTES = 8
#: Key bits that come from the id.
ID_BITS = 23
#: Rows of the table of pieces up to which it is broadcast.
BROADCAST_PIECES = 1_000_000
TOP = 1 << 62


def sort_key(id_col: str, text_col: str) -> Column:
    text = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), ID_BITS + 2)
    own = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col), F.lit(0))), 64 - ID_BITS)
    return F.shiftleft(text, ID_BITS).bitwiseOR(own)


def _below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows in the intervals that the sorted probes cut; a probe belongs to the interval above it."""

    def count(batches):
        held = np.zeros((2, len(probes) + 1), np.int64)
        for batch in batches:
            size = batch.column("size").to_numpy()
            place = np.searchsorted(probes, batch.column("key").to_numpy(), side="right")
            np.add.at(held[0], place, size)
            held[1] += np.bincount(place, minlength=len(probes) + 1)
        some = np.flatnonzero(held[1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, *held[:, some])], ["place", "size", "n"])

    counts = keys.select("key", "size").mapInArrow(count, "place long, size long, n long")
    out = np.zeros((2, len(probes) + 1), np.int64)
    for row in counts.groupBy("place").agg(F.sum("size"), F.sum("n")).collect():
        out[:, row[0]] = row[1:]
    return out[0], out[1]


def splitters(keys: DataFrame, n: int, tolerance: float = 0.02, probes_each: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """``n - 1`` sorted keys that cut the bytes of (key, size) into n nearly equal parts, within ``tolerance`` of a
    part; and the exact rows of each part. A splitter's own key is the first of the part above it."""
    probes = np.unique(np.linspace(0, TOP, max(64, n * probes_each) + 1).astype(np.int64)[1:-1])
    size, rows = _below(keys, probes)
    total = int(size.sum())
    wanted = np.arange(1, n) * total / n
    allowed = max(1.0, tolerance * total / n)
    known, below = probes, np.cumsum(size)[:-1]  # bytes under each known key
    rows_below = np.cumsum(rows)[:-1]
    while True:
        borders = np.concatenate(([0], known, [TOP]))
        sums = np.concatenate(([0], below, [total]))
        counts = np.concatenate(([0], rows_below, [int(rows.sum())]))
        right = np.searchsorted(sums, wanted, side="left").clip(1, len(sums) - 1)
        left = right - 1
        nearer = np.where(wanted - sums[left] <= sums[right] - wanted, left, right)
        open_ = (np.abs(sums[nearer] - wanted) > allowed) & (borders[right] - borders[left] > 1)
        if not open_.any():
            break
        low, high = borders[left[open_]], borders[right[open_]]
        share = (wanted[open_] - sums[left[open_]]) / np.maximum(1, sums[right[open_]] - sums[left[open_]])
        # half of the probes spread evenly, half around the expected place
        even = np.linspace(0, 1, probes_each + 2)[1:-1]
        near = np.clip(share[:, None] + np.array([-0.02, -0.005, 0, 0.005, 0.02]), 0, 1)
        cut = np.concatenate([np.broadcast_to(even, (len(share), len(even))), near], axis=1)
        new = low[:, None] + np.clip((cut * (high - low)[:, None]).astype(np.int64), 1, (high - low)[:, None] - 1)
        # keep what brackets an open splitter, what was chosen, and the new ones
        useful = np.unique(np.concatenate([new.ravel(), borders[left], borders[right], borders[nearer]]))
        probes = useful[(useful > 0) & (useful < TOP)]
        size, rows = _below(keys, probes)
        known, below, rows_below = probes, np.cumsum(size)[:-1], np.cumsum(rows)[:-1]
    cuts, at = borders[nearer], counts[nearer]
    return cuts, np.diff(np.concatenate(([0], at, [int(rows.sum())])))


def _whole_groups(keys: DataFrame, borders: np.ndarray, n_shards: int, tolerance: float) -> np.ndarray:
    """The sorted shard borders, each moved to the nearer end of the group of equal texts that it cuts, where the bytes
    below stay within half of ``tolerance`` of a shard of those wanted."""
    first = borders >> ID_BITS << ID_BITS
    ends = np.stack([first, np.where(borders > first, first + (1 << ID_BITS), first)])
    probes = np.unique(np.concatenate([borders, ends.ravel()]))
    size, _ = _below(keys, probes)
    below = np.cumsum(size)[:-1]
    total = int(size.sum())
    away = np.abs(below[np.searchsorted(probes, ends)] - np.arange(1, n_shards) * total / n_shards)
    best = away.argmin(axis=0)
    moved = np.where(away.min(axis=0) <= tolerance / 2 * total / n_shards, ends[best, np.arange(len(borders))], borders)
    return np.maximum.accumulate(moved)


def cut_pieces(
    keys: DataFrame, n_shards: int, tolerance: float, rows_per_piece: int, least_pieces: int, bytes_per_piece: int = 256 << 20
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys that cut (key, size) into pieces, the exact rows of each piece and its shard. Shards are nearly equal
    in bytes; no piece has more than ``rows_per_piece`` rows but for those of one key, nor more than ``bytes_per_piece``
    beyond the tolerance and the document at its border."""
    total, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    pieces = max(least_pieces, *(math.ceil(x / n_shards) for x in (total / rows_per_piece, size / bytes_per_piece)))
    cuts, rows = splitters(keys, n_shards * pieces, tolerance)
    borders = cuts[pieces - 1 :: pieces]
    moved = _whole_groups(keys, borders, n_shards, tolerance) if n_shards > 1 else borders
    more = np.empty(0, np.int64)
    heavy = rows > rows_per_piece
    if heavy.any():
        # parts so much smaller that they stay small enough with both borders at the end of their tolerance
        part = max(1, rows_per_piece - 2 * max(1, math.ceil(tolerance * rows_per_piece)))
        more, _ = splitters(keys.withColumn("size", F.lit(1).cast("long")), math.ceil(total / part), tolerance)
        more = more[heavy[np.searchsorted(cuts, more, side="right")]]
    # moved borders come beside the old ones, so pieces only get smaller
    finer = np.unique(np.concatenate([cuts, moved, more]))
    _, rows = _below(keys, finer)
    return finer, rows, np.searchsorted(moved, np.concatenate(([0], finer)), side="right")


def shard(
    docs: DataFrame, n_shards: int = 24, tolerance: float = 0.02, rows_per_piece: int = 100_000, least_pieces: int = 4,
    bytes_per_piece: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``size`` (bytes of the text and ``ROW_BYTES``), ``shard`` (sizes nearly equal) and ``slot``
    (gapless from 0 in each shard), after one exchange of the documents."""
    scratch = Scratch(docs.sparkSession)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES
    keys = scratch.keep(docs.select(sort_key(id_col, text_col).alias("key"), size.alias("size")), "shard_keys")
    cuts, rows, owner = cut_pieces(keys, n_shards, tolerance, rows_per_piece, least_pieces, bytes_per_piece)
    scratch.drop(keys)
    before = np.cumsum(rows) - rows
    before -= before[np.searchsorted(owner, owner)]  # rows of the shard before each piece
    shared = docs.sparkSession.sparkContext.broadcast(cuts)  # one number for each piece

    @F.pandas_udf("int")
    def piece_of(key):
        import pandas as pd

        return pd.Series(np.searchsorted(shared.value, key.to_numpy(), side="right").astype(np.int32))

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]
    placed = docs.select(
        F.struct(*others).alias("row"), F.col(id_col).alias("id"), size.alias("size"),
        sort_key(id_col, text_col).alias("key"), piece_of(sort_key(id_col, text_col)).alias("piece"),
    )
    numbers = [(i, int(x), int(s)) for i, (x, s) in enumerate(zip(before, owner))]
    starts = docs.sparkSession.createDataFrame(numbers, "place int, start long, owner int")
    rank = F.row_number().over(Window.partitionBy("piece").orderBy("key", "id", "size"))
    ranked = placed.withColumn("rank", rank)
    # one row for each piece
    small = F.broadcast(starts) if len(numbers) <= BROADCAST_PIECES else starts
    found = ranked.join(small, ranked["piece"] == starts["place"])
    return found.select(
        "row.*", "size", F.col("owner").alias("shard"),
        (F.col("start") + F.col("rank") - 1).alias("slot"),
    )
