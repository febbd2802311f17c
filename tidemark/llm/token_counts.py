"""Token counts from pre-token frequencies.

1. Every distinct pre-token of the corpus is found, with the number of
   documents that hold it, and its pieces are counted once.
2. Each document's pre-token frequencies are joined to these counts and
   summed; no document's ids are ever made. The ``HEAD_TERMS`` most frequent
   pre-tokens are joined on the map side from a table whose size this bound
   fixes, as a long one stands there by a digest; all others by a shuffle join
   on the pre-token. Frequent pre-tokens thereby never meet in one task.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pre_tokens import splitter
from tidemark.llm.scratch import written
from tidemark.llm.words import lean, slices

HEAD_TERMS = 150_000
HEAD_BYTES = 48  # a longer pre-token is known to the workers by its SHA-256
KNOWN_TERMS = 500_000  # counts a task holds before it passes them on


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _pre_tokens(path: str, pattern: str):
    """Split a text into pre-tokens, and count its special strings."""
    import regex

    found = splitter(pattern)
    special = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values() if t.special]
    cut = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def split(text: str | None) -> tuple[list[str], int]:
        if not text:
            return [], 0
        if cut is None or not cut.search(text):
            return found(text), 0
        parts = cut.split(text)
        return [p for part in parts for p in found(part)], len(parts) - 1

    return split


def piece_counts(docs: DataFrame, tokenizer_path: str, pattern: str, text: str = "text") -> DataFrame:
    """(term, docs, n): each distinct pre-token, the documents that hold it, and its pieces."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = _pre_tokens(tokenizer_path, pattern), Counter()

        def passed_on():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "docs"])

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for t in part.column(0).to_pylist():
                    seen.update(set(split(t)[0]))
                if len(seen) > KNOWN_TERMS:
                    yield passed_on()
                    seen.clear()
        if seen:
            yield passed_on()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            n = [len(e.ids) for e in tokenizer.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int32())], names=["term", "docs", "n"])

    distinct = docs.select(F.col(text).alias("text")).mapInArrow(lean(terms), "term string, docs long")
    return distinct.groupBy("term").agg(F.sum("docs").alias("docs")).mapInArrow(lean(count), "term string, docs long, n int")


def head_key(term: str) -> str | bytes:
    """How the head knows a pre-token: by itself, or by a digest if it is long."""
    if 4 * len(term) <= HEAD_BYTES or len(raw := term.encode()) <= HEAD_BYTES:
        return term
    return sha256(raw).digest()


def _head(pieces: DataFrame) -> dict[str | bytes, int]:
    """Pieces of the most frequent pre-tokens by ``head_key``, at most ``HEAD_TERMS``; tasks send no others to the driver."""
    levels = pieces.withColumn("level", F.floor(F.log2("docs") * 8))
    lowest, total = None, 0
    for r in levels.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        total += r.n
        if total > HEAD_TERMS:
            break
        lowest = r.level
    if lowest is None:
        return {}
    long = F.octet_length("term") > HEAD_BYTES
    columns = [F.when(~long, F.col("term")).alias("term"), F.when(long, F.unhex(F.sha2(F.col("term").cast("binary"), 256))).alias("digest"), "n"]
    table = levels.where(F.col("level") >= lowest).select(*columns).toArrow()
    return {t if d is None else d: n for t, d, n in zip(*(table[c].to_pylist() for c in ("term", "digest", "n")), strict=True)}


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row for each row of ``docs``: its key, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens. Rows are counted one by
    one, so repeated, tied or null keys each keep a row of their own. Other
    columns are left out, whatever their names. An empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    pieces = written(piece_counts(own, tokenizer_path, pattern), "pieces")
    head = docs.sparkSession.sparkContext.broadcast(_head(pieces))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = _pre_tokens(tokenizer_path, pattern), head.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows, terms, freqs = [], [], []
                sums = []
                for i, t in enumerate(part.column("text").to_pylist()):
                    found, total = split(t)
                    for term, f in Counter(found).items():
                        n = known.get(head_key(term))
                        if n is None:
                            rows.append(i)
                            terms.append(term)
                            freqs.append(f)
                        else:
                            total += n * f
                    sums.append(total)
                n = len(sums)
                at = pa.array([*range(n), *rows], pa.int64())
                own_only = pa.array([*range(n), *[None] * len(rows)], pa.int64())  # key and size stand in one row only
                columns = [part.column("row").take(at), part.column("key").take(own_only), part.column("n_bytes").take(own_only)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([None] * n + terms, pa.string()), pa.array(sums + freqs, pa.int64())], names=["row", "key", "n_bytes", "term", "freq"])

    rows = own.select(F.monotonically_increasing_id().alias("row"), "key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    kind = docs.schema[key].dataType.simpleString()
    parts = written(rows.mapInArrow(lean(frequencies), f"row long, key {kind}, n_bytes long, term string, freq long"), "frequencies")
    summed = parts.where("term is null").select("row", "key", "n_bytes", "freq")
    rare = parts.where("term is not null").select("row", "term", "freq").join(pieces.select("term", "n"), "term")
    rare = rare.select("row", (F.col("freq") * F.col("n")).alias("n")).groupBy("row").agg(F.sum("n").alias("n"))
    out = summed.join(rare, "row", "left").select("key", "n_bytes", (F.col("freq") + F.coalesce("n", F.lit(0))).alias("n_tokens"))
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
