"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition is one run: its rows' digests, sorted. In each round
``FAN_IN`` neighbouring runs are merged into one, digest by digest, keeping the
verified best identifier and the count, until one run is left. A merged run
doesn't lie in one partition: rounds exchange by a hash of run and digest, and
sort again what arrives, so that the last run is spread over all tasks as the
first ones are. Copies are merged inside a run before anything is sent, so a
group sends at most one row a run and round. What the last run says goes back
the same way: to one row for each run and digest, then to the run's rows. No
task ever sees all of a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import sent_if_small, written

FAN_IN = 16
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, "")


def digest_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Write one sorted run for each partition: digest, a second hash, the identifier, and with ``carry`` the row as ``doc``."""
    doc = [F.struct("*").alias("doc")] if carry else []
    own = docs.select(*doc, F.col(key).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("n_points"), normalised(text).alias("norm"))
    runs = own.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.xxhash64("norm").alias("verify"),
        "id",
        "n_points",
        *(["doc"] if carry else []),
    )
    return written(runs.sortWithinPartitions("digest"), "digest-runs")


def tree_merge(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(digest, verify, best, n): one row for each distinct text.

    ``best`` is the row with the most code points, then the smallest
    identifier (null last), then the first of identical rows. The second hash
    is part of what is compared at every level.
    """
    best = F.struct((-F.col("n_points")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id", "row")
    level = runs.select("run", "digest", "verify", best.alias("best"), F.lit(1).cast("long").alias("n"))
    left = (runs.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        left = -(-left // fan_in)
        level = level.groupBy((F.col("run") / fan_in).cast("int").alias("run"), "digest", "verify").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        if left == 1:
            return level.drop("run")


def label(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty.
    Of rows identical in all of that, exactly one stays. Null keys come last.
    Other columns play no part; an empty table gives no rows.
    """
    runs = digest_runs(docs, key, text)
    known = runs.select("run", "digest", "verify").distinct().join(tree_merge(runs), ["digest", "verify"])
    joined = runs.join(known, ["run", "digest", "verify"])
    return joined.select(
        F.col("id").alias(key),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts."""
    runs = digest_runs(docs, key, text, carry=True)
    best = written(tree_merge(runs.drop("doc")).select(F.col("best.row").alias("row")), "kept-rows")
    return runs.select("row", "doc").join(sent_if_small(best, F.lit(8)), "row", "left_semi").select("doc.*")


LABEL_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
h AS (SELECT doc_id, n, sha256(norm) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w = 1 AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""
