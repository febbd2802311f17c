"""From raw documents to training tokens, stage by stage.

Every stage reads all its predecessor kept and its decisions take effect:
documents without a language go, one document of each group of equal texts
and of each near-duplicate component stays, the mix repeats or leaves out
documents by its targets, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, jaccard, language_id, mixing
from tidemark.llm.scratch import discard, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language that the model predicts in ``lang``; those of none (``und``) go.

    The model learns from the ``lang`` that documents came with. Null, empty and
    letterless texts are rejected; repeated rows are judged alike; very long
    texts are read whole. Other columns stay, whatever their names; an empty
    table, or one without labels, leaves no rows.
    """
    model = language_id.train(docs)
    whole = docs.select(F.struct("*").alias("doc"), F.col("text").alias("text"))
    found = language_id.predict(whole, model).where(F.col("lang_pred") != language_id.UNDETERMINED)
    return found.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal without white space, as exact dedup picks it.

    Null and empty texts are equal; of rows alike in text and id one stays; null
    ids come last. Other columns stay; an empty table gives no rows.
    """
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links: shingles of five words, similarity 0.8 or more.

    Documents without words link with nothing and stay; of rows alike in text
    and id one stays; ids may be null or repeat. Other columns stay; an empty
    table gives no rows.
    """
    return jaccard.first_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a source's last one may be cut to its first words.

    Documents without words are never taken; a null source is one of its own.
    Rows repeated in the input are mixed one by one. Other columns stay, and
    ``n_chars`` follows a cut text; an empty table gives no rows.
    """
    return mixing.mixed_rows(docs, n_chars="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the bytes decoded from them.

    Null and empty texts have no ids; every row gives one, repeated or not.
    Columns other than doc_id, lang and source end here; an empty table gives
    no rows.
    """
    import public_tokenizers

    made = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    return made.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]

#: SQL can't express the language classifier, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and read by the next."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, done = written(stage(spark, docs, sf_dir), f"pipeline-{name}"), read
        read = docs
        if done is not None:
            discard(done)
    return STAGES[-1][1](spark, docs, sf_dir)
