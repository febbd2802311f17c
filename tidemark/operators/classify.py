"""New, amended or known: incoming bars against stored history, and versions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas as S

COMPARED = ("open", "high", "low", "close", "volume", "adj_close")
TOLERANCE = 0.001


def _with_key(df: DataFrame) -> DataFrame:
    return df if "bar_time_utc" in df.columns else df.withColumn("bar_time_utc", F.lit(None).cast("string"))


def _same_key(a: str, b: str) -> Column:
    return reduce(and_, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) if k == "bar_time_utc" else F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in S.KEY])


def latest(bars: DataFrame) -> DataFrame:
    """The highest version of each key; ties go to the later ingestion, then batch."""
    bars = _with_key(bars)
    order = [F.col(c).desc_nulls_last() for c in ("record_version", "ingested_at", "batch_id") if c in bars.columns]
    return bars.withColumn("__n", F.row_number().over(W.partitionBy(*S.KEY).orderBy(*order))).where("__n = 1").drop("__n")


def classify(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``action`` (new, amend, skip), ``old_version`` and ``old_batch`` to incoming bars.

    Stored rows are cut to the incoming keys before their versions are ranked,
    so that only those few meet the window. A price that is null on either
    side doesn't differ. Repeated incoming keys are classified one by one.
    """
    incoming, stored = _with_key(incoming), _with_key(stored)
    keys = incoming.select(*S.KEY).distinct()
    have = stored.alias("s").join(keys.alias("k"), _same_key("s", "k"), "left_semi")
    compared = [c for c in COMPARED if c in incoming.columns and c in stored.columns]
    have = latest(have).select(*S.KEY, *compared, S.field(stored, "record_version").alias("old_version"), S.field(stored, "batch_id").alias("old_batch"))
    joined = incoming.alias("i").join(have.alias("s"), _same_key("i", "s"), "left")
    differs = reduce(or_, [F.coalesce(F.abs(F.col(f"i.{c}") - F.col(f"s.{c}")) > TOLERANCE, F.lit(False)) for c in compared])
    action = F.when(F.col("s.symbol").isNull(), "new").when(differs, "amend").otherwise("skip")
    return joined.select("i.*", action.alias("action"), F.col("s.old_version"), F.col("s.old_batch"))


def amend(classified: DataFrame, batch_id: str, reason: str = "provider_correction") -> DataFrame:
    """Amended bars as the next version of what they correct."""
    if reason not in S.AMENDMENT_REASONS:
        raise ValueError(f"unknown amendment reason {reason}")
    out = classified.where("action = 'amend'")
    fixed = {
        "record_version": (F.coalesce("old_version", F.lit(1)) + 1).cast("int"),
        "supersedes_batch": F.col("old_batch"),
        "is_amended": F.lit(True),
        "amendment_reason": F.lit(reason),
        "batch_id": F.lit(batch_id),
        "data_quality_flag": F.lit(False),
        "data_quality_reasons": F.lit("[]"),
    }
    return out.withColumns(fixed).drop("action", "old_version", "old_batch")


def amend_fields(stored: DataFrame, changes: DataFrame, batch_id: str, reason: str) -> DataFrame:
    """New versions of stored bars with the changed fields; only ``AMENDABLE`` fields may change.

    A null in ``changes`` leaves the field as it is.
    """
    changed = [c for c in changes.columns if c not in S.KEY]
    if wrong := set(changed) - set(S.AMENDABLE):
        raise ValueError(f"fields that can't be amended: {sorted(wrong)}")
    if reason not in S.AMENDMENT_REASONS:
        raise ValueError(f"unknown amendment reason {reason}")
    from tidemark.functions.metrics import has_corporate_action

    stored, changes = _with_key(stored), _with_key(changes)
    # Only what changes meets the window.
    some = stored.alias("s").join(changes.select(*S.KEY).distinct().alias("c"), _same_key("s", "c"), "left_semi")
    joined = latest(some).alias("s").join(changes.alias("c"), _same_key("s", "c"))
    columns = [F.coalesce(F.col(f"c.{n}"), F.col(f"s.{n}")).alias(n) if n in changed else F.col(f"s.{n}") for n in stored.columns]
    out = joined.select(*columns)
    out = out.withColumns(
        {
            "supersedes_batch": S.field(out, "batch_id"), "record_version": (F.coalesce(S.field(out, "record_version"), F.lit(1)) + 1).cast("int"), "batch_id": F.lit(batch_id),
            "is_amended": F.lit(True), "amendment_reason": F.lit(reason), "data_quality_flag": F.lit(False), "data_quality_reasons": F.lit("[]"),
        }
    )
    return out.withColumn("has_corporate_action", has_corporate_action(out))


def record_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", "interval").agg(F.count("*").alias("record_count"))


def first_non_empty(frames: list[DataFrame], key: tuple[str, ...] = ("symbol", "date", "interval")) -> DataFrame:
    """Sources in order of priority: each later one fills only the keys that no earlier one has."""
    ranked = reduce(DataFrame.unionByName, [f.withColumn("__rank", F.lit(i)) for i, f in enumerate(frames)])
    first = W.partitionBy(*key).orderBy("__rank")
    return ranked.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__rank")
