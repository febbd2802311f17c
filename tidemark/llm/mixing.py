"""Mixing sources to target weights, in DataFrame operations only.

Every row gets a hash-random key. Rows are sorted by (source, key) over range
partitions, so that a large source lies on many; each row's place in its
source is a prefix sum: rows before it in its partition plus the sums of its
source's earlier partitions. A source is cut exactly where the sum reaches
its budget; whole epochs come first where the budget exceeds the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.scratch import sent_if_small, written

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)  # by the source's rank, repeating
GAP = r"[\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Number of runs of characters other than white space; null has none."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), GAP)
    ends = (F.element_at(parts, 1) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.greatest(F.size(parts) - ends, F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for (source, source_size): by weight, at most ``max_epochs`` times a source's size.

    The sizes' total is shared by weight; what a source can't take is reshared
    among the others. With sources in order of size per weight, those at their
    bound come first, so the level at which the sharing ends is that of the
    first source which stays below. There is one row for each source.
    """
    rank = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(rank)).withColumn("weight", pick).withColumn("bound", F.col("source_size") * max_epochs)
    order = W.orderBy((F.col("bound") / F.col("weight")), "rank")
    before, every = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    levels = ranked.select(
        "*",
        ((F.sum("source_size").over(every) - F.coalesce(F.sum("bound").over(before), F.lit(0))).cast("double") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"),
        F.row_number().over(order).alias("place"),
    )
    free = F.when(F.col("level") <= F.col("bound") / F.col("weight"), F.struct("place", "level"))
    ended = levels.withColumn("end", F.min(free).over(every))
    return ended.select("source", "source_size", F.least(F.col("bound").cast("double"), F.col("end.level") * F.col("weight")).alias("target"))


def take(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add source_size, target and taken to rows of (row, id, source, size, key).

    ``taken`` is the number of words that the mix takes of a row: its whole
    size for each full epoch of its source, and in the last epoch what lies
    before the cut, which may fall inside one row of each source.
    """
    sorted_rows = rows.repartitionByRange("source", "key", "row").withColumn("part", F.spark_partition_id())
    sorted_rows = written(sorted_rows.sortWithinPartitions("source", "key", "row"), "mix-sorted")
    sums = sorted_rows.groupBy("part", "source").agg(F.sum("size").alias("part_size"))
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("part", "source", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("offset"))
    sizes = sorted_rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    blocks = sums.alias("a").join(targets.alias("t"), F.col("a.source").eqNullSafe(F.col("t.source"))).select("a.part", "a.source", "offset", "source_size", "target")
    inside = W.partitionBy("part", "source").orderBy("key", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = sorted_rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.alias("d").join(blocks.alias("b"), (F.col("d.part") == F.col("b.part")) & F.col("d.source").eqNullSafe(F.col("b.source")))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("row", "id", "d.source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _keyed(docs: DataFrame, key: str, source: str, text: str) -> list[Column]:
    said = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))
    return [F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), F.md5(said.cast("binary")).alias("key")]


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row for each row of ``docs``: its key, size, source_size, target, taken.

    Null texts have size 0 and are never taken; a null source is a source of
    its own, ranked last. Random keys come from key and text, so reruns agree;
    rows identical in both may swap places, which changes no result row. Other
    columns play no part; an empty table gives no rows.
    """
    made = take(docs.select(*_keyed(docs, key, source, text)), weights, max_epochs)
    return made.select(F.col("id").alias(key), "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", n_chars: str | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each row once for each epoch that takes it, with all its columns.

    The one row of a source that the cut divides comes with its first words
    only; ``n_chars`` names a column that is set to the length of that text.
    """
    rows = written(docs.select(F.struct("*").alias("doc"), *_keyed(docs, key, source, text)), "mix-rows")
    made = take(rows.drop("doc"), weights, max_epochs).where("taken > 0").select("row", "size", "taken")
    made = sent_if_small(written(made, "mix-taken"), F.lit(24))
    pieces = F.transform(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")), lambda i: F.least(F.col("size"), F.col("taken") - (i - 1) * F.col("size")))
    out = rows.select("row", "doc").join(made, "row").select("doc", "size", F.explode(pieces).alias("words"))
    whole = F.col("doc").getField(text)
    first = F.array_join(F.slice(F.split(F.regexp_replace(whole, rf"^{GAP}", ""), GAP), F.lit(1), F.col("words").cast("int")), " ")
    cut = F.when(F.col("words") < F.col("size"), first)
    own = {text: F.coalesce(cut, whole)}
    if n_chars:
        own[n_chars] = F.coalesce(F.length(cut).cast(docs.schema[n_chars].dataType), F.col("doc").getField(n_chars))
    return out.select(*[own.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS bound FROM s),
l AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM r WINDOW o AS (ORDER BY CAST(bound AS DOUBLE) / weight, rank)),
e AS (SELECT arg_min(level, place) AS level FROM l WHERE level <= CAST(bound AS DOUBLE) / weight),
t AS (SELECT source, source_size, least(CAST(bound AS DOUBLE), (SELECT level FROM e) * weight) AS target FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN budget // greatest(source_size, 1) ELSE 0 END AS epochs FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - earlier)) AS BIGINT) AS taken
FROM p
"""
