"""Words and their hashes for whole Arrow batches of text, as numpy arrays.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; in UTF-8 these
bytes never occur inside another character, so working on bytes is exact.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

# Odd 64-bit multipliers (fractional parts of irrational numbers).
MUL_A = np.uint64(0x9E3779B97F4A7C15)
MUL_B = np.uint64(0xC2B2AE3D27D4EB4F)
MUL_C = np.uint64(0x165667B19E3779F9)
SLICE_BYTES = 1 << 20
GIVE_BACK = 16


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every other."""
    h = h ^ (h >> np.uint64(31))
    h = h * MUL_B
    h ^= h >> np.uint64(29)
    h *= MUL_C
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Words:
    """Words of the rows of one slice: byte ranges in ``data`` and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # n_rows + 1 entries

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes at a step."""
        length = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        eight = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        h = mix(length.astype(np.uint64) * MUL_A + np.uint64(seed))
        live, at, left = np.arange(len(length)), self.starts, length
        while len(live):
            chunk = eight[at]
            short = left < 8
            bits = (np.uint64(64) - (left[short].astype(np.uint64) << np.uint64(3)))
            chunk[short] = (chunk[short] << bits) >> bits
            h[live] = mix((h[live] ^ chunk) * MUL_A + np.uint64(0x51ED))
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        return h


def _give_back() -> None:
    """Return freed memory to the system, so that an idle worker stays small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving memory back every ``GIVE_BACK`` batches and at the end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for n, batch in enumerate(run(batches), 1):
                yield batch
                if n % GIVE_BACK == 0:
                    _give_back()
        finally:
            _give_back()

    return wrapped


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Find the words of rows that lie one after another in ``data``."""
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    if not len(data):
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # a word never runs over the end of a row
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``max_bytes`` of text, or one row."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        upto = max(upto, at + 1)
        yield batch.slice(at, upto - at)
        at = upto


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n (base odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, np.uint64(b), dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 1 << 23:
            _POWERS[base] = have
    return have


def span_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i; a span's hash is its difference times base**-start."""
    power, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the sequences values[start:end]."""
    _, inverse = powers(base, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * MUL_A)
