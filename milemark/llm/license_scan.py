"""License scan: templates retrieved by MinHash bands over overlapping text windows, verified by exact containment.

Words are runs of letters and digits, lower-cased; shingles are five consecutive words. A template's shingles are cut
into segments of at most ``SEGMENT``; a segment of s shingles belongs to the class c, the power of two with
c / 2 < s <= c. A document's shingles are covered by windows of 2 c shingles every c, so that each run of c shingles
lies inside a window. If a document holds the share ``containment`` of a template, it holds that share of one of its
segments, and the window around it has a Jaccard similarity with the segment that is bounded from below by the class.
Bands of one MinHash each are as many as make a miss less likely than ``miss`` at that bound. What they retrieve is
then verified with the exact sets of shingles: matched are templates whose containment is reached.

Templates go to the tasks in blocks of bounded size, one pass over the documents for each block; documents are never
shuffled, and matches are found where the document is.

Defined cases: null and empty texts hold no template; a template of fewer words than a shingle cannot be found and is
refused; a document may hold several templates, one row each; repeated rows are reported each; texts of any length are
read whole; without documents or templates there are no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from milemark.llm.batches import text_slices

SHINGLE = 5
SEGMENT = 32
#: Bytes of templates in one pass.
BLOCK_BYTES = 4 << 20

#: ASCII signs become blanks, letters small; bytes of other characters stay.
_PLAIN = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(128)).lower() + bytes(range(128, 256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_PLAIN).split()


def shingles(own: list[bytes]) -> list[bytes]:
    return [b" ".join(own[i : i + SHINGLE]) for i in range(len(own) - SHINGLE + 1)]


def _hashes(own: list[bytes]) -> np.ndarray:
    if len(own) < SHINGLE:
        return np.zeros(0, np.uint64)
    line = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1)).tolist()
    return np.fromiter((xxh64_intdigest(line[a:b]) for a, b in zip(begins, ends[SHINGLE - 1 :].tolist())), np.uint64)


def least_similarity(size: int, containment: float) -> float:
    """Smallest Jaccard similarity of a window of class ``size`` that holds enough of a segment."""
    worst = 1.0
    for s in range(size // 2 + 1, size + 1):
        held = math.ceil(containment * s - 1e-9)
        worst = min(worst, held / (2 * size + s - held))
    return worst


def bands_needed(similarity: float, miss: float) -> int:
    return math.ceil(math.log(miss) / math.log1p(-similarity))


class Templates:
    """One block of templates with the band tables of its segments."""

    def __init__(self, rows: list[tuple[str, str]], containment: float, miss: float):
        self.containment = containment
        self.sets: dict[str, set[bytes]] = {}
        segments: dict[int, list[tuple[str, np.ndarray]]] = defaultdict(list)
        for name, text in rows:
            own = words(text)
            hashes = _hashes(own)
            if not len(hashes):
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            self.sets[name] = set(shingles(own))
            for begin in range(0, len(hashes), SEGMENT):
                part = hashes[begin : begin + SEGMENT]
                segments[1 << (len(part) - 1).bit_length()].append((name, part))
        rng = np.random.default_rng(0)
        self.classes = []
        for size, members in sorted(segments.items()):
            tables = []
            for odd in rng.integers(1 << 63, size=bands_needed(least_similarity(size, containment), miss), dtype=np.uint64) | np.uint64(1):
                found: dict[int, set[str]] = defaultdict(set)
                for name, part in members:
                    found[int((part * odd >> np.uint64(32)).min())].add(name)
                first = np.zeros(1 << 16, bool)
                first[[value >> 16 for value in found]] = True
                tables.append((odd, first, found))
            self.classes.append((size, tables))

    def candidates(self, hashes: np.ndarray, owners: np.ndarray) -> set[tuple[int, str]]:
        """(document, template) pairs that share a band in a window. Documents lie one after the other, so a window
        may reach into the next one: all documents in it are candidates."""
        out: set[tuple[int, str]] = set()
        if not len(hashes):
            return out
        for size, tables in self.classes:
            begins = np.arange(0, len(hashes), size)
            for odd, first, found in tables:
                low = np.minimum.reduceat((hashes * odd >> np.uint64(32)).astype(np.uint32), begins)
                low[:-1] = np.minimum(low[:-1], low[1:])
                for w in np.flatnonzero(first[low >> np.uint32(16)]).tolist():
                    for name in found.get(int(low[w]), ()):
                        inside = owners[w * size : (w + 2) * size]
                        out.update((int(d), name) for d in range(inside[0], inside[-1] + 1))
        return out

    def scan(self, texts: list[str | None]) -> list[tuple[int, str, int, int]]:
        """(document, template, shingles of the template, of these found) of all verified matches."""
        own = [words(text) for text in texts]
        hashes = [_hashes(w) for w in own]
        owners = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
        pairs = self.candidates(np.concatenate([*hashes, np.zeros(0, np.uint64)]), owners)
        out, sets = [], {}
        for d, name in sorted(pairs):
            if d not in sets:
                sets = {d: set(shingles(own[d]))}
            template = self.sets[name]
            held = len(template & sets[d])
            if held >= self.containment * len(template) - 1e-9:
                out.append((d, name, len(template), held))
        return out


def _blocks(templates: Iterable[tuple[str, str]]) -> Iterable[list[tuple[str, str]]]:
    block, held = [], 0
    for name, text in templates:
        if block and held + len(text) > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((name, text))
        held += len(text)
    if block:
        yield block


def scan(
    docs: DataFrame, templates: Iterable[tuple[str, str]], containment: float = 0.8, miss: float = 1e-6,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row for each document and template that it holds: the id column, ``license``, ``n_shingles`` (distinct, of
    the template), ``n_found`` and ``containment``. ``templates`` are (name, text) pairs, read block by block."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("license", T.StringType())])
    schema.add("n_shingles", T.LongType()).add("n_found", T.LongType())
    context = docs.sparkSession.sparkContext

    def one_pass(block):
        shared = context.broadcast((block, containment, miss))

        def run(batches):
            tables = Templates(*shared.value)
            for batch in batches:
                for part in text_slices(batch, "_text"):
                    found = tables.scan(part.column("_text").to_pylist())
                    rows = part.column("_id").take(pa.array([x[0] for x in found], pa.int64()))
                    kinds = pa.string(), pa.int64(), pa.int64()
                    columns = [pa.array([x[i + 1] for x in found], kind) for i, kind in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([rows, *columns], schema.names)

        return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)

    out = None
    for block in _blocks(templates):
        found = one_pass(block)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


# Short notices and opening passages of well-known public licenses.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "Apache-2.0-header",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version.",
    ),
]
