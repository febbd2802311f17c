"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier for each bit
(naive Bayes on hashed byte trigrams of the letters) says on which side of the
bit a text lies; a text's language is the codeword with the least loss, bits
weighted by how often they were right on the training rows.

Training rows: at most about ``ROWS_PER_LANGUAGE`` labelled rows a language,
chosen by a hash of the key; the counts behind every weight are summed on the
executors. Every language is learned, however rare. What reaches the driver is
one count for each language and bucket that occurs in the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.scratch import without
from tidemark.llm.words import lean, slices, text_bytes

BUCKETS = 1 << 15
ROWS_PER_LANGUAGE = 4000
UNDETERMINED = "und"
HELD_LANGUAGES = 128  # whose counts a task holds before it passes them on
SMOOTH = 0.1
TAU = 6.0  # a mean log-odds of 1/TAU per trigram is a margin of 1
AMBIGUOUS = 0.6  # a score below this is flagged

# Bytes as classifiers see them: A-Z in lower case, other ASCII that isn't a letter as space, non-ASCII as it is.
_SEEN = np.full(256, 0x20, dtype=np.uint8)
_SEEN[0x61:0x7B] = np.arange(0x61, 0x7B)
_SEEN[0x41:0x5B] = np.arange(0x61, 0x7B)
_SEEN[0x80:] = np.arange(0x80, 0x100)


def trigram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams that hold a letter, row after row, and each row's first."""
    sizes = np.diff(offsets)
    padded = np.full(len(data) + len(sizes) + 2, 0x20, dtype=np.uint32)
    place = np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes) + 1
    padded[place] = _SEEN[data]
    # Row i now starts behind a space at offsets[i] + i.
    code = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    middle = padded[1:-1] != 0x20  # one trigram for each letter byte
    at = np.flatnonzero(middle)
    bucket = ((code[at] * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int32)
    return bucket, np.searchsorted(at, offsets + np.arange(len(offsets)))


def code_matrix(n: int) -> np.ndarray:
    """n codewords of bits in {-1, 1}: the exhaustive code up to five languages, else the best of 64 random codes.

    All codewords differ; a random code has 10 bits for each doubling of languages.
    """
    if n < 2:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        half = (1 << (n - 1)) - 1
        bits = np.array([[1 if i == 0 or (half_bits >> (i - 1)) & 1 == 0 else -1 for half_bits in range(1, half + 1)] for i in range(n)])
        return bits.astype(np.int8)
    rng, length, best = np.random.default_rng(20), int(np.ceil(10 * np.log2(n))), None
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), (n, length))
        split = np.abs(code.astype(int).sum(axis=0)) < n
        far = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(far, -length)
        if best is None or (split.all(), -far.max()) > best[0]:
            best = ((split.all(), -far.max()), code)
    return best[1]


def bit_weights(code: np.ndarray, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
    """BUCKETS x bits log-odds from counts by language and bucket: mean shares of the languages on either side, smoothed by ``SMOOTH``."""
    whole = np.bincount(lang, n, len(code)) + SMOOTH * BUCKETS
    out = np.zeros((BUCKETS, code.shape[1]), dtype=np.float32)
    for at, bit in enumerate(code.T):
        sides = []
        for side in (1, -1):
            mine = bit == side
            if not mine.any():
                sides.append(np.full(BUCKETS, 1.0 / BUCKETS))
                continue
            rows = mine[lang]
            share = np.bincount(bucket[rows], n[rows] / whole[lang[rows]], BUCKETS) + (SMOOTH / whole[mine]).sum()
            sides.append(share / mine.sum())
        out[:, at] = np.clip(np.log(sides[0]) - np.log(sides[1]), -4, 4)
    return out


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # BUCKETS x bits, log-odds
    bit_weight: np.ndarray

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's margin for each bit, and its number of trigrams."""
        bucket, first = trigram_buckets(data, offsets)
        counts = np.diff(first)
        sums = np.zeros((len(counts), self.weights.shape[1]))
        full = np.flatnonzero(counts)
        if len(full):
            sums[full] = np.add.reduceat(self.weights[bucket], first[full], axis=0)
        return TAU * sums / np.maximum(counts, 1)[:, None], counts

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword for each row and its score from 0 to 1."""
        loss = np.stack([(np.logaddexp(0.0, -margins * word) * self.bit_weight).sum(axis=1) for word in self.code], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), (1.0 / share.sum(axis=1))


def held_out(key: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the key as text leaves 2 modulo 4; a null key isn't held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit on labelled rows that aren't held out; None if there are none.

    Rows without key, text or label teach nothing, so neither does a held-out
    row with a null key. Rows that repeat a key are taken or left together.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("key is not null and lang is not null and text is not null").where(~held_out("key"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return None
    # One literal, as the driver knows all languages: a join would send every text to the task of its language.
    part = F.map_from_arrays(F.lit(languages), F.lit([min(1.0, ROWS_PER_LANGUAGE / sizes[g]) for g in languages]))
    sample = rows.where(F.pmod(F.xxhash64(F.lit("train"), "key"), F.lit(1 << 20)) < F.element_at(part, F.col("lang")) * (1 << 20)).select("lang", "text")
    place = {g: i for i, g in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for i, n in seen.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = text_bytes(piece.column(1))
                bucket, first = trigram_buckets(data, offsets)
                label = np.array([place[g] for g in piece.column(0).to_pylist()])
                each = np.repeat(label, np.diff(first))
                for i in np.unique(label):
                    seen[i] = seen.get(i, 0) + np.bincount(bucket[each == i], minlength=BUCKETS)
                if len(seen) > HELD_LANGUAGES:
                    yield from passed_on()
                    seen.clear()
        yield from passed_on()

    table = sample.mapInArrow(lean(count), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).orderBy("lang", "bucket").toArrow()
    code = code_matrix(len(languages))
    weights = bit_weights(code, table["lang"].to_numpy(), table["bucket"].to_numpy(), table["n"].to_numpy())
    model = Model(languages, code, weights, np.ones(code.shape[1]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for piece in slices(batch, "text"):
                margins, _ = m.margins(*text_bytes(piece.column(1)))
                right = margins * m.code[[place[g] for g in piece.column(0).to_pylist()]] > 0
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(right.shape[1]), pa.int32()), pa.array(right.sum(axis=0), pa.int64()), pa.array(np.full(right.shape[1], len(right)), pa.int64())], names=["bit", "ok", "n"])

    judged = sample.mapInArrow(lean(judge), "bit int, ok long, n long").groupBy("bit").agg(F.sum("ok").alias("ok"), F.sum("n").alias("n")).collect()
    for r in judged:
        error = min(max(1 - r.ok / r.n, 0.001), 0.499)
        model.bit_weight[r.bit] = np.log((1 - error) / error)
    model.bit_weight /= model.bit_weight.sum()
    model.bit_weight *= len(model.bit_weight)
    return model


@lru_cache(maxsize=1)
def _letter():
    import regex

    return regex.compile(r"\p{L}").search


def predict(docs: DataFrame, model: Model | None, text: str = "text", out: str = "lang_pred") -> DataFrame:
    """Add the language, its score (0 to 1) and whether the decision is ambiguous.

    Whole texts are read; null texts, and texts without a letter, are ``und``
    with score 0 and ambiguous; so is everything if there was nothing to learn
    from. Other columns stay, but for those with the name of an output, which
    the output replaces. Rows may repeat; an empty table gives no rows.
    """
    names = [out, "score", "ambiguous"]
    docs = without(docs, *names)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letter = sent.value, _letter()
        for batch in batches:
            for piece in slices(batch, text):
                column = piece.column(piece.schema.get_field_index(text))
                has = np.array([m is not None and t is not None and letter(t) is not None for t in column.to_pylist()], dtype=bool)
                best, score = np.zeros(len(has), dtype=int), np.zeros(len(has))
                if has.any():
                    best, score = m.decode(m.margins(*text_bytes(column))[0])
                score = np.where(has, np.clip(score, 0.0, 1.0), 0.0)
                label = [m.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(label, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], names=schema.names)

    return docs.mapInArrow(lean(run), schema)
