"""Byte-level BPE encoding and decoding through a sentencepiece model built from a rank file.

The model is serialised straight from the vocabulary: each token's bytes are written as one character per
byte (U+0100 + byte), its score is minus its rank, normalisation is the identity.  Merging the best-scored pair
first is then merging the pair of least rank first, which is what the rank file asks for.  Text is cut by the
vocabulary's pattern; each match is encoded by itself, and a match that is a token as it stands is that token.
Decoding maps the ids back to their pieces and the characters of these back to bytes.

Defined results.  Null text: no ids, like the empty text.  Null ids decode to no bytes.  Special tokens don't exist; their strings are
ordinary text.  Repeated rows are encoded alike; ties can't occur, as ranks differ; very long texts are encoded whole, in one task.  An empty table gives no
rows; extra columns are kept and may have any name.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.frames import fresh, modest_batches

FIRST_CHARACTER = 0x100
#: Encoded matches that a task remembers.
REMEMBERED = 100_000
#: Rows handled at once inside a task.
ROWS = 128

_TO_TEXT = {b: chr(FIRST_CHARACTER + b) for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, blank, rank), by rank."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks of a vocabulary must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A field in protocol buffers' wire format."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def as_text(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_TEXT)


def as_bytes(piece: str) -> bytes:
    return bytes(ord(c) - FIRST_CHARACTER for c in piece)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model of type BPE whose ids are the ranks; the id after them stands for unknown."""
    # Fixed values of the format: piece type 1 normal, 2 unknown; model type 2 BPE.
    pieces = [_field(1, as_text(t).encode()) + _field(2, float(-rank)) for rank, t in enumerate(tokens)]
    unknown = _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)
    absent = 2**64 - 1  # -1 as a varint
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, absent) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in [*pieces, unknown]) + _field(2, trainer) + _field(3, normaliser)


class Encoder:
    """The model inside a task, with the ids of recent matches."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.matches = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def _learn(self, matches: set[str]) -> None:
        if len(self.known) + len(matches) > REMEMBERED:
            self.known = {}
        rest = []
        for m in matches:
            i = self.whole.get(m.encode())
            if i is None:
                rest.append(m)
            else:
                self.known[m] = [i]
        if rest:
            self.known.update(zip(rest, self.pieces.encode([as_text(m.encode()) for m in rest], num_threads=1), strict=True))

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.matches(t) for t in texts]
        new = {m for c in cut for m in c if m not in self.known}
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                new = {m for c in cut for m in c}
            self._learn(new)
        known, out = self.known, []
        for c in cut:
            ids: list[int] = []
            for m in c:
                ids += known[m]
            out.append(ids)
        return out


class Decoder:
    """ids to bytes by the inverse mapping of the model's pieces."""

    def __init__(self, tokens: list[bytes]):
        pieces = [as_bytes(as_text(t)) for t in tokens]
        self.length = np.array([len(p) for p in pieces], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows, bounds of the rows in them) of ids whose rows have these bounds."""
        length = self.length[ids]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - (ends - length), length)
        return self.flat[at], np.concatenate([[0], ends])[bounds]



def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ids_col: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` plus ``ids_col`` (array<int>), the last column; ``_`` is put before its name where the input has one like it.  The rank file is read by the driver and broadcast; a vocabulary is a
    fixed file of about a megabyte that doesn't grow with the input."""
    kept = [c for c in docs.columns if keep_text or c != text_col]
    ids_col = fresh(docs.select(*[F.col(f"`{c}`") for c in kept]), ids_col)
    modest_batches(docs.sparkSession)
    tokens = read_ranks(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((sentencepiece_model(tokens), tokens))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value, pattern)
        for b in batches:
            for first in range(0, b.num_rows, ROWS):
                part = b.slice(first, ROWS)
                ids = encoder.encode([t or "" for t in part.column(text_col).to_pylist()])
                bounds = np.cumsum([0, *map(len, ids)])
                flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=bounds[-1])
                column = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], column], names=[*kept, ids_col])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``rows`` plus ``bytes_col`` (binary), the last column, named as in ``encode``: the bytes that the ids stand for."""
    bytes_col = fresh(rows, bytes_col)
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = T.StructType([*rows.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for b in batches:
            for first in range(0, b.num_rows, ROWS):
                part = b.slice(first, ROWS)
                lists = part.column(ids_col).fill_null([])
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                data, cuts = decoder.decode(ids, bounds)
                column = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, bytes_col])

    return rows.mapInArrow(run, schema)
