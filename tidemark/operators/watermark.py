"""High-water marks as pure functions: old table and updates in, new table out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUSPEND_AFTER = 3


def bounds(written: DataFrame, by: tuple[str, ...] = ("symbol", "interval")) -> DataFrame:
    """First and last date and number of the bars written, for each key."""
    return written.groupBy(*by).agg(F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"), F.count("*").alias("record_count"))


def upsert(old: DataFrame, updates: DataFrame, key: tuple[str, ...] = ("instrument_id", "stream"), now: Column | None = None) -> DataFrame:
    """The table after the updates (at most one a key).

    Dates only widen, counts replace, a run that isn't a success adds to the
    failures and success clears them; three failures suspend. ``created_at``
    of a known key stays. ``run_status`` of an update is success or not.
    """
    stamp = F.current_timestamp().cast("string") if now is None else now
    joined = old.alias("o").join(updates.alias("u"), [F.col(f"o.{k}") == F.col(f"u.{k}") for k in key], "full_outer")
    touched = F.col(f"u.{key[0]}").isNotNull()
    take = lambda c: F.when(touched, F.coalesce(F.col(f"u.{c}"), F.col(f"o.{c}"))).otherwise(F.col(f"o.{c}"))
    ok = F.col("u.run_status") == "success"
    failures = F.when(~touched, F.col("o.consecutive_failures")).when(ok, 0).otherwise(F.coalesce(F.col("o.consecutive_failures"), F.lit(0)) + 1)
    out = joined.select(
        *[F.coalesce(F.col(f"u.{k}"), F.col(f"o.{k}")).alias(k) for k in key],
        F.least("o.earliest_date", "u.earliest_date").alias("earliest_date"),
        F.greatest("o.latest_date", "u.latest_date").alias("latest_date"),
        *[take(c).alias(c) for c in ("record_count", "batch_id", "mode")],
        F.when(touched, F.when(failures >= SUSPEND_AFTER, "suspended").otherwise("active")).otherwise(F.col("o.status")).alias("status"),
        failures.cast("int").alias("consecutive_failures"),
        F.coalesce(F.col("o.created_at"), stamp).alias("created_at"),
        F.when(touched, stamp).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )
    return out


def upsert_by_symbol(old: DataFrame, updates: DataFrame) -> DataFrame:
    """The older table by (symbol, interval): dates widen, the rest replaces."""
    key = ("symbol", "interval")
    joined = old.alias("o").join(updates.alias("u"), [F.col(f"o.{k}") == F.col(f"u.{k}") for k in key], "full_outer")
    both = lambda c: F.coalesce(F.col(f"u.{c}"), F.col(f"o.{c}")).alias(c)
    return joined.select(
        *map(both, key), F.least("o.earliest_date", "u.earliest_date").alias("earliest_date"), F.greatest("o.latest_date", "u.latest_date").alias("latest_date"),
        *map(both, ("record_count", "batch_id", "mode")),
    )


def find(table: DataFrame, stream: str | None = None, **key) -> DataFrame:
    """Watermarks of a stream (all without one), or of one key."""
    if stream is not None:
        table = table.where(F.col("stream") == stream)
    for k, v in key.items():
        table = table.where(F.col(k) == v)
    return table
