"""Byte-level BPE through a sentencepiece model built from the vocabulary alone.

The ranks of a byte-level vocabulary are serialised as a sentencepiece BPE
model: every byte becomes one character, every token one piece whose score is
its negative rank, and normalisation is the identity. Merging the adjacent
pair of highest score is then merging the pair of lowest rank, so the model
encodes each pre-token as the ranks do. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.pre_tokens import splitter
from tidemark.llm.scratch import without
from tidemark.llm.words import lean, slices

BYTE_BASE = 0x2800  # byte b is written as the character BYTE_BASE + b: 256 symbols without case or space
BYTE_CHARS = [chr(BYTE_BASE + b) for b in range(256)]
_TO_CHARS = {b: BYTE_BASE + b for b in range(256)}
CACHE_ENTRIES = 120_000  # pre-tokens remembered by a worker
CACHE_BYTES = 64  # longer pre-tokens are encoded anew each time


def as_chars(raw: bytes) -> str:
    """One character for each byte."""
    return raw.decode("latin-1").translate(_TO_CHARS)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of base64 tokens and ranks; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens) or len(set(tokens)) != len(tokens):
        raise ValueError(f"{path}: ranks aren't 0 to {len(tokens) - 1}, each with its own token")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: an int as varint, a float as 32 bits, bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: ids are ranks, the unknown piece comes last."""
    # Fixed values of the format: field numbers; piece types 1 normal, 2 unknown; model type 2 BPE.
    pieces = [_field(1, as_chars(t).encode()) + _field(2, float(-rank)) + _field(3, 1) for rank, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec(dict):
    """Encodes pre-tokens and decodes ids; as a dict it remembers the ids of short pre-tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import sentencepiece

        super().__init__()
        self.tokens = read_ranks(ranks_path)
        self.whole = {t: (i,) for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.pieces = splitter(pattern)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        ids = self.whole.get(raw) or tuple(self.model.encode(as_chars(raw)))
        if len(raw) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; null and empty give none."""
        return array("i", chain.from_iterable(map(self.__getitem__, self.pieces(text or ""))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _lists(parts: list, values: pa.Array) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the token ids of each row's whole text, and on request the bytes decoded from them.

    Input columns stay, but for one with the name of an output, which the
    output replaces. Null and empty texts give an empty list. Rows may repeat; nothing is shuffled.
    ``ranks_path`` must be readable on every worker.
    """
    df = without(df, ids, *([decoded] if decoded else []))
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    fields += [T.StructField(decoded, T.BinaryType())] if decoded else []
    schema = T.StructType([*df.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                out = [c.encode(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                flat = np.frombuffer(b"".join(a.tobytes() for a in out), dtype=np.int32)
                columns = [*part.columns, _lists(out, pa.array(flat))]
                if decoded:
                    columns.append(pa.array([c.decode(a) for a in out], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(lean(run), schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the bytes that each row's ids stand for; a null list stays null, an unknown id is an error."""
    df = without(df, text)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = read_ranks(ranks_path)
        for batch in batches:
            raw = [None if a is None else b"".join(map(tokens.__getitem__, a)) for a in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=schema.names)

    return df.mapInArrow(lean(run), schema)
