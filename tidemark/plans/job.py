"""The daily ingestion as one set-based job over all symbols."""

from __future__ import annotations

import os
import subprocess
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.config import Stream
from tidemark.functions import rules
from tidemark.operators import classify as K
from tidemark.operators import validate as V
from tidemark.operators import watermark as M
from tidemark.operators._scratch import discard, written
from tidemark.store import TableStore


FAILED_MODE = "unknown"


def batch_id(stream: str, now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"batch_{stream}_{now.astimezone(timezone.utc):%Y%m%d_%H%M%S}"


def pipeline_version() -> str:
    """From the environment, else the commit that is checked out, else unknown."""
    if found := os.environ.get("PIPELINE_VERSION"):
        return found
    try:
        return subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=True, timeout=5).stdout.strip() or "unknown"
    except (OSError, subprocess.SubprocessError):
        return "unknown"


def planned(bars: DataFrame, plans: DataFrame) -> DataFrame:
    """Bars that the plans ask for."""
    wanted = plans.where("mode != 'NO_OP'").select("symbol", "start_date", "end_date")
    return bars.join(wanted, "symbol").where(F.col("date").between(F.col("start_date"), F.col("end_date"))).drop("start_date", "end_date")


def run_summary(classified: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row of totals over symbols: written, amended, skipped, rejected, success rate."""
    n = lambda a: F.count_if(F.col("action") == a)
    by_symbol = classified.groupBy("symbol").agg(n("new").alias("written"), n("amend").alias("amended"), n("skip").alias("skipped"))
    bad = rejected.groupBy("symbol").agg(F.count("*").alias("rejected"))
    both = by_symbol.join(bad, "symbol", "full_outer").na.fill(0)
    ok = F.count_if(F.col("written") + F.col("amended") + F.col("skipped") > 0)
    totals = both.agg(F.count("*").alias("total_symbols"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("written", "amended", "skipped", "rejected")], ok.alias("ok_symbols"))
    rate = F.when(F.col("total_symbols") == 0, 100.0).otherwise(F.bround(F.col("ok_symbols") / F.greatest("total_symbols", F.lit(1)) * 100, 1))
    return totals.withColumn("success_rate_pct", rate)


def run_report(classified: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row for each symbol of a run."""
    n = lambda a: F.count_if(F.col("action") == a)
    made = classified.groupBy("symbol").agg(n("new").alias("written"), n("amend").alias("amended"), n("skip").alias("skipped"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    bad = rejected.groupBy("symbol").agg(F.count("*").alias("rejected"))
    return made.join(bad, "symbol", "full_outer").na.fill(0, ["written", "amended", "skipped", "rejected"])


FILE_ROWS = 2_000_000  # of a month's bars in one file


def partitioned(bars: DataFrame, n: int) -> DataFrame:
    """Bars by month, dealt so that a month is one file, or as many as it needs."""
    salt = F.pmod(F.xxhash64("symbol", "date"), F.lit(max(1, n // FILE_ROWS)))
    return bars.withColumn("month", F.date_format("date", "yyyy-MM")).repartition("interval", "month", salt)


Months = list[tuple[str, str]]


def months_of(bars: DataFrame) -> Months:
    """The (interval, month) pairs of a batch."""
    rows = bars.where("date is not null").select("interval", F.date_format("date", "yyyy-MM").alias("month")).distinct().collect()
    return sorted((r.interval, r.month) for r in rows if r.interval is not None)


def stored_bars(store: TableStore, table: str, months: Months | None = None) -> DataFrame:
    """Stored bars; with ``months``, those of these months only, so that other files aren't read."""
    stored = store.read(table, S.BARS_SCHEMA)
    if "month" not in stored.columns:
        return stored
    if months is not None:
        by_interval: dict[str, list[str]] = {}
        for interval, month in months:
            by_interval.setdefault(interval, []).append(month)
        wanted = F.lit(False)
        for interval, own in by_interval.items():
            wanted = wanted | (F.col("interval") == interval) & F.col("month").isin(own)
        stored = stored.where(wanted)
    return stored.drop("month")


def refresh_silver(store: TableStore, table: str, silver: str, months: Months) -> None:
    """Bring the table of latest versions up to date for the months that a batch touched.

    Only these months of the stored bars are read and ranked, and only they are
    written; a version never leaves its month, as the date is part of its key.
    """
    if months:
        rows = K.latest(stored_bars(store, table, months))
        store.replace_partitions(silver, partitioned(S.conform(rows, S.BARS_SCHEMA), 0), ("interval", "month"))


@dataclass
class Ingested:
    """What a batch did, all of it from tables that were written on the way.

    ``counters`` were counted while the batch was written: outcomes, dates,
    hits of each rule. ``by_symbol``: bars landed, written, amended, unchanged,
    rejected. ``alerts``: rules on the order of bars. ``discard`` removes the
    tables, after which the frames can't be read.
    """

    counters: dict[str, Any]
    summary: DataFrame
    by_symbol: DataFrame
    hits: DataFrame
    alerts: DataFrame
    months: Months
    tables: tuple[DataFrame, ...]

    def discard(self) -> None:
        discard(*self.tables)


def _hits(spark: SparkSession, counters: dict[str, Any], stream: Stream) -> DataFrame:
    rows = [(r.name, r.severity, counters[f"hits_{r.name}"]) for r in rules.rule_set(stream) if counters.get(f"hits_{r.name}")]
    return spark.createDataFrame(rows, "rule string, severity string, hits long")


def _by_symbol(checked: DataFrame, classified: DataFrame) -> DataFrame:
    n = lambda a: F.count_if(F.col("action") == a)
    seen = checked.groupBy("symbol").agg(F.count("*").alias("landed"), F.count_if(F.col("outcome") == "rejected").alias("rejected"))
    made = classified.groupBy("symbol").agg(n("new").alias("written"), n("amend").alias("amended"), n("skip").alias("unchanged"))
    out = seen.withColumnRenamed("symbol", "s").join(made, F.col("s").eqNullSafe(F.col("symbol")), "left")
    return out.select(F.col("s").alias("symbol"), "landed", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("written", "amended", "unchanged")], "rejected")


def ingest_batch(
    store: TableStore, bars: DataFrame, stream: Stream, batch: str, version: str = "unknown", instruments: DataFrame | None = None, now: Column | None = None, dry_run: bool = False,
    plans: DataFrame | None = None, failures: DataFrame | None = None,
) -> Ingested:
    """Validate, classify and append a batch.

    Bars go to ``stream.table``, rejects beside it. Nothing is appended twice:
    known bars are skipped, changed ones come as new versions, and rejects that
    the batch has stored already stay as they are. With ``instruments``
    (symbol, instrument_id), watermarks of the symbols that got bars move: they
    are read off the stored bars of this batch, so that a batch which died
    before them and is run again moves them too; a run that skips everything
    leaves them. ``plans`` (symbol, mode, ingestion_type) say how each symbol
    was fetched; ``failures`` (symbol, error) count against the watermarks that
    exist. Bars are validated and counted once, in the pass that writes them.
    """
    now = F.lit(datetime.now(timezone.utc)) if now is None else now
    kind: Column | str = "scheduled"
    if plans is not None:
        bars = bars.join(plans.select("symbol", F.col("ingestion_type").alias("__kind")), "symbol", "left")
        kind = F.coalesce("__kind", F.lit("scheduled"))
    validated, seen = V.validate(bars, stream), Observation(f"ingest-{uuid.uuid4().hex}")
    checked = written(validated.observe(seen, *V.counters(stream)), "checked")
    counted = seen.get
    enriched = S.conform(V.enrich(V.writable(checked), batch, version, kind, now=now, nullable=stream.nullable), S.BARS_SCHEMA)
    months = months_of(V.writable(checked))
    # Three sinks read this, and it must not see what they append.
    classified = written(K.classify(enriched, stored_bars(store, stream.table, months)), "classified")
    rejected = V.rejected_records(checked.drop("__kind"), batch, version, now)
    alerts = V.order_alerts(checked, stream)
    done = Ingested(counted, run_summary(classified, rejected), _by_symbol(checked, classified), _hits(store.spark, counted, stream), alerts, months, (checked, classified))
    if dry_run:
        return done
    new = S.conform(classified.where("action = 'new'"), S.BARS_SCHEMA)
    amended = S.conform(K.amend(classified, batch), S.BARS_SCHEMA)
    store.append(stream.table, partitioned(new.unionByName(amended), counted["total_input"]), ("interval", "month"))
    _append_rejects(store, rejected, batch)
    if instruments is not None:
        _move_watermarks(store, stream, batch, months, instruments, plans, failures)
    return done


def ingest(store: TableStore, bars: DataFrame, stream: Stream, batch: str, *args: Any, **kwargs: Any) -> DataFrame:
    """``ingest_batch``; its summary alone."""
    return ingest_batch(store, bars, stream, batch, *args, **kwargs).summary


def reprocess_rejects(store: TableStore, stream: Stream, batch: str, version: str = "unknown", now: Column | None = None) -> DataFrame:
    """Judge the stored open rejects again by the stream's rules as they are now; the summary of what that stored.

    Bars that pass are ingested as a batch of their own, then their rejects are
    closed. A batch that died between the two is run again: its bars are known
    by then, and its rejects are closed. Rejects that fail again stay open and
    aren't stored twice.
    """
    rejects = store.read("market_data_rejected", S.REJECT_SCHEMA)
    judged = written(V.rejudged(rejects, stream), "rejudged")
    bars = V.writable(judged).drop("reject", "fired", "outcome", "deciding_rule")
    summary = ingest_batch(store, bars, stream, batch, version, now=now).summary
    if not V.writable(judged).isEmpty():
        store.replace("market_data_rejected", S.conform(V.closed(rejects, judged, batch, now), S.REJECT_SCHEMA))
    return summary


def _append_rejects(store: TableStore, rejected: DataFrame, batch: str) -> None:
    """Append the batch's rejects, less those that an earlier try of it has stored: each as often as it is missing."""
    from pyspark.sql import Window as W

    key = ["batch_id", "symbol", "date", "interval", "raw_record"]
    nth = F.row_number().over(W.partitionBy(*key).orderBy("rejected_at"))
    have = store.read("market_data_rejected", S.REJECT_SCHEMA).where(F.col("batch_id") == batch).select(*key, nth.alias("nth")).alias("h")
    rows = rejected.withColumn("nth", nth).alias("r")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in (*key, "nth")]
    store.append("market_data_rejected", rows.join(have, same, "left_anti").drop("nth"))


def _move_watermarks(store: TableStore, stream: Stream, batch: str, months: Months, instruments: DataFrame, plans: DataFrame | None, failures: DataFrame | None) -> None:
    ids = instruments.select("symbol", "instrument_id")
    added = stored_bars(store, stream.table, months).where(F.col("batch_id") == batch)
    moved = M.bounds(added, ("symbol",)).join(ids, "symbol")
    mode: Column = F.lit("INCREMENTAL")
    if plans is not None:
        moved, mode = moved.join(plans.select("symbol", F.col("mode").alias("__mode")), "symbol", "left"), F.coalesce("__mode", F.lit("INCREMENTAL"))
    row = lambda df, mode, status: df.select("instrument_id", F.lit(stream.name).alias("stream"), "earliest_date", "latest_date", "record_count", F.lit(batch).alias("batch_id"), mode.alias("mode"), F.lit(status).alias("run_status"))
    old = store.read("ingestion_watermark", S.WATERMARK_SCHEMA)
    updates = row(moved, mode, "success")
    if failures is not None:
        # A failure that this batch has counted before isn't counted again.
        mine = (F.col("stream") == stream.name) & ((F.col("batch_id") != batch) | (F.col("mode") != FAILED_MODE))
        known = old.where(mine).select("instrument_id", *[F.lit(None).cast(old.schema[c].dataType).alias(c) for c in ("earliest_date", "latest_date", "record_count")])
        failed = ids.join(failures.select("symbol").distinct(), "symbol", "left_semi").select("instrument_id").join(updates.select("instrument_id"), "instrument_id", "left_anti")
        updates = updates.unionByName(row(known.join(failed, "instrument_id", "left_semi"), F.lit(FAILED_MODE), "failed"))
    if not updates.isEmpty():
        store.replace("ingestion_watermark", S.conform(M.upsert(old, updates), S.WATERMARK_SCHEMA))
