"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every byte string of the vocabulary becomes a piece over a 256-letter alphabet
of printable characters; its score is its negative rank, so that sentencepiece
joins pairs in the order of the ranks.  The model file is serialised here, with
an identity normaliser.  Texts are cut into pre-tokens by the public pattern.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import slices
from .pretokens import Encoder

#: A piece that no byte string maps to.
UNKNOWN = "⁇"


def alphabet() -> list[str]:
    """The letter of each byte: itself where it prints as one Latin-1 sign, else the next free one from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte string of each rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes | str) -> bytes:
    """One protocol-buffer field: a varint, a 32-bit float or a length-prefixed string."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece model: the unknown piece, then the vocabulary by rank, so an id is a rank plus one."""
    letters = alphabet()
    pieces = [_field(1, UNKNOWN) + _field(2, 0.0) + _field(3, 2)]
    for rank, token in enumerate(vocabulary):
        pieces.append(_field(1, "".join(letters[b] for b in token)) + _field(2, float(-rank)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + b"".join(_field(k, v) for k, v in ((40, 0), (41, -1), (42, -1), (43, -1), (45, UNKNOWN)))
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


@lru_cache(2)
def model_of(path: str):
    """The sentencepiece model of a rank file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=serialise(read_ranks(path)))


@lru_cache(2)
def byte_strings(path: str) -> list[bytes]:
    """What each id stands for: the letters of the model's pieces, turned back into bytes."""
    model, byte = model_of(path), {c: b for b, c in enumerate(alphabet())}
    return [bytes(map(byte.__getitem__, model.id_to_piece(k))) for k in range(1, model.get_piece_size())]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    vocabulary, model = read_ranks(path), model_of(path)
    rank_of = {token: rank for rank, token in enumerate(vocabulary)}
    letters = {b: c for b, c in enumerate(alphabet())}

    def encode(words: list[str]) -> list:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out = [rank_of.get(b) for b in raw]
        parts = [i for i, rank in enumerate(out) if rank is None]
        for i, ids in zip(parts, model.encode([raw[i].decode("latin-1").translate(letters) for i in parts], num_threads=1), strict=True):
            out[i] = [x - 1 for x in ids]
        return [[x] if isinstance(x, int) else x for x in out]

    return Encoder(encode)


def joined(token: list[bytes], ids: np.ndarray) -> bytes:
    """The bytes that ids stand for."""
    return b"".join(map(token.__getitem__, ids.tolist()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id_col, ids[, decoded]): ids of the whole text, as little-endian unsigned 32-bit integers in one binary value.

    With decoded, the ids are also turned back into bytes, as decode() does, in
    the same pass.

    path is that of a rank file, which every executor can read.  A null text
    counts as empty and has no ids.  Other columns are left out; repeated rows
    are encoded each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, token = encoder(path), byte_strings(path) if decoded else []
        for batch in slices(batches, 2 << 20):
            ids = [x.astype("<u4") for x in encoded.batch([x or "" for x in batch.column(1).to_pylist()])]
            out = {"id": batch.column(0), "ids": pa.array([x.tobytes() for x in ids], pa.binary())}
            if decoded:
                out["decoded"] = pa.array([joined(token, x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, ids binary" + ", decoded binary" * decoded).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, ids_col, decoded): the bytes that the ids stand for.  Null ids have null bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = byte_strings(path)
        for batch in slices(batches):
            raw = [None if x is None else joined(token, np.frombuffer(x, "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], ["id", "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, ids binary, decoded binary").withColumnsRenamed({"id": id_col, "ids": ids_col})
