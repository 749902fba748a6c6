"""Byte-level BPE: texts to token ids and back, by the ranks of a published vocabulary.

Every match of the split pattern is encoded on its own. The tokenizers library does the merges; its vocabulary
is the rank file with each byte written as one printable character, its merges are all ways to cut a token into
two other tokens, ordered by rank, so that any pair whose join is a token may merge, as in the rank file's own
library. Words repeat, so a task encodes each distinct match once and remembers a bounded number of them.

Python's regex splits the text, as it is several times faster than the library's own splitter. The two know different
versions of Unicode: a text with characters that Python's database does not know goes to the library's splitter.

Defined cases: null text is the empty text and has no tokens; special tokens do not exist here, their strings are
ordinary text; repeated rows are encoded each on its own; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Split

from milemark.llm.batches import text_slices

#: Distinct matches that a Python worker remembers; it forgets all beyond that.
MEMORY = 200_000
#: Largest rank file that is sent to the executors.
MAX_RANK_BYTES = 32 << 20


def byte_characters() -> dict[int, str]:
    """Byte to printable character: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def _unassigned() -> str:
    """Character class of the code points without a category in Python's Unicode database."""
    missing = [cp for cp in range(0x110000) if unicodedata.category(chr(cp)) == "Cn"]
    ends = [a for a, b in zip(missing, [*missing[1:], -1]) if b != a + 1]
    begins = [b for a, b in zip([-2, *missing], missing) if b != a + 1]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends)) + "]"


class _Remembered(dict):
    """Match to the bytes of its ids (int32), encoded when it is first asked for."""

    def __init__(self, model: Tokenizer):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.model.encode(piece, add_special_tokens=False).ids, np.int32).tobytes()
        self[piece] = ids
        return ids


class Bytes:
    """The way back: the bytes of each id."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        # spelled as the tokenizers library spells them, and read back by the reversed byte table
        back = {character: byte for byte, character in byte_characters().items()}
        self.bytes_of = {rank: bytes(back[c] for c in spelling) for spelling, rank in self.spelled().items()}
        in_order = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.length = np.array([len(token) for token in in_order], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.table = np.frombuffer(b"".join(in_order), np.uint8)

    def spelled(self) -> dict[str, int]:
        written = byte_characters()
        return {"".join(written[b] for b in token): rank for token, rank in self.ranks.items()}

    def decode(self, ids: Iterable[int]) -> bytes | None:
        """The bytes of the ids; None if there is no such id."""
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        except KeyError:
            return None

    def decode_rows(self, ids: pa.ListArray) -> pa.BinaryArray:
        """``decode`` of each row, by one look-up in the table of all tokens' bytes."""
        flat = ids.flatten()
        known = np.asarray(pc.fill_null(flat, -1))
        inside = (known >= 0) & (known < len(self.length))
        known = np.where(inside, known, 0)
        length = np.where(inside, self.length[known], 0)
        after = np.concatenate(([0], np.cumsum(length)))
        data = self.table[np.repeat(self.begin[known] - after[:-1], length) + np.arange(after[-1])]
        rows = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(ids), 0)))))
        wrong = np.concatenate(([0], np.cumsum(length == 0)))[rows]
        valid = np.asarray(ids.is_valid()) & (np.diff(wrong) == 0)
        borders = pa.py_buffer(after[rows].astype(np.int32))
        whole = pa.Array.from_buffers(pa.binary(), len(ids), [None, borders, pa.py_buffer(data)])
        return pc.if_else(pa.array(valid), whole, pa.scalar(None, pa.binary()))

    def decode_pieces(self, pieces: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of one piece of ids after the other; a character cut by a border comes with the later piece."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in pieces:
            yield reader.decode(self.decode(ids) or b"")
        if rest := reader.decode(b"", True):
            yield rest


class Vocabulary(Bytes):
    """A rank file as a tokenizers model, with the way back."""

    def __init__(self, content: bytes, pattern: str):
        super().__init__(content)
        written = byte_characters()
        spell = lambda token: "".join(written[b] for b in token)
        merges = [
            (spell(token[:i]), spell(token[i:]))
            for token in sorted(self.ranks, key=self.ranks.__getitem__)
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.model = Tokenizer(BPE(vocab=self.spelled(), merges=merges, ignore_merges=True))
        self.model.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.matches = regex.compile(pattern).findall
        self.careful = Split(Regex(pattern), "isolated")
        self.unknown = re.compile(_unassigned()).search
        self.uncommon = re.compile("[\u0378-\U0010ffff]").search  # below, all code points are assigned
        self.known = _Remembered(self.model)

    def split(self, text: str) -> list[str]:
        first = None if text.isascii() else self.uncommon(text)
        if first and self.unknown(text, first.start()):
            return [piece for piece, _ in self.careful.pre_tokenize_str(text)]
        return self.matches(text)

    def encode(self, text: str) -> np.ndarray:
        if len(self.known) > MEMORY:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.split(text))), np.int32)

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last, by token; tokens that share a character all hold it."""
        after = np.cumsum(self.length[ids])
        before = after - self.length[ids]
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80)
        return character[before] - 1, character[after - 1]


@lru_cache(2)
def vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """One model for each worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabulary(content, pattern)


@lru_cache(2)
def byte_table(content: bytes) -> Bytes:
    return Bytes(content)


def read_ranks(path: str) -> bytes:
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    with open(path, "rb") as file:
        return file.read()


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    borders = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    return pa.ListArray.from_arrays(
        pa.array(borders, pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)]), pa.int32(), safe=False)
    )


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """Token ids of every whole text: the id column, ``token_ids``; with ``offsets`` also ``begins`` and ``ends``,
    the characters of the text that each token covers."""
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        words = vocabulary(content.value, pattern)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                texts = [text or "" for text in part.column("_text").to_pylist()]
                ids = [words.encode(text) for text in texts]
                columns = [part.column("_id"), _lists(ids)]
                if offsets:
                    columns += map(_lists, zip(*(words.offsets(text, x) for text, x in zip(texts, ids))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "token_ids", *["begins", "ends"] * offsets]
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)])
    for name in names[1:]:
        schema.add(name, T.ArrayType(T.IntegerType(), False))
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "token_ids", as_text: bool = False) -> DataFrame:
    """All columns of ``tokens`` and ``decoded``: the bytes of the ids, or with ``as_text`` their text, where bytes
    that form no character become U+FFFD. Null ids and ids outside the vocabulary give null. A column of the same
    name is replaced."""
    content = tokens.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in tokens.columns if c != "decoded"]

    def run(batches):
        words = byte_table(content.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                out = words.decode_rows(part.column(ids_col))
                if as_text:
                    texts = [None if x is None else x.decode("utf-8", "replace") for x in out.to_pylist()]
                    out = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*kept, "decoded"])

    schema = T.StructType([tokens.schema[c] for c in kept])
    return tokens.select(*kept).mapInArrow(run, schema.add("decoded", T.StringType() if as_text else T.BinaryType()))
