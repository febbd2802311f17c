"""The queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import LABEL_SQL
from tidemark.llm.mixing import MIX_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.token_counts import token_counts

    docs = _table(spark, sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import chat

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.render_turns(turns.unionAll(extra)))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import ann

    return ann.nearest(_table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import mixing

    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.jaccard import near_duplicates

    made = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return made.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import exact_dedup

    return exact_dedup.label(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import language_id

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    made = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return made.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import html_text

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    made = html_text.extract(pages, html_text.learn(pages))
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm import bpe

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.repeats import remove_repeats

    made = remove_repeats(_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import kmeans

    return kmeans.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm import packing

    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import repair

    return repair.repair(repair.damage(_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_format": op2_chat_format,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_mix_sources": op4_mix_sources,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_html_text": op8_html_text,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {"op4_mix_sources": MIX_SQL, "op6_exact_dedup": LABEL_SQL}
