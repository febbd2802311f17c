"""A whole run: watermarks, plans, provider, chunks, ingestion and a report, for all symbols at once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import watermark as M
from tidemark.operators._scratch import discard, written
from tidemark.plans import planner as P
from tidemark.plans.job import Ingested, ingest_batch, planned
from tidemark.sources import providers
from tidemark.sources.chunks import Fetch, failed_chunks, fetch_chunks
from tidemark.store import TableStore


@dataclass
class Run:
    """What a run did. What a dry run, which plans only, doesn't know is None.

    ``failed`` are the chunks that couldn't be read. ``batch`` has the batch's
    counters, rule hits and alerts. ``discard`` removes the tables behind all
    of it, after which the frames can't be read.
    """

    plans: DataFrame
    requests: DataFrame
    provider: str | None
    summary: DataFrame | None
    report: DataFrame
    failed: DataFrame | None = None
    batch: Ingested | None = None
    tables: tuple[DataFrame, ...] = ()

    def discard(self) -> None:
        discard(*self.tables)
        if self.batch:
            self.batch.discard()


def plan_run(store: TableStore, tickers: DataFrame, cfg: P.PlanConfig, today: Column | date, start: date | None = None, end: date | None = None) -> DataFrame:
    """The plan of every ticker (symbol, instrument_id, history_start) from its stored watermark; dates given by hand win."""
    marks = M.find(store.read("ingestion_watermark", S.WATERMARK_SCHEMA), cfg.stream.name)
    marks = marks.select("instrument_id", F.col("earliest_date").alias("wm_earliest"), F.col("latest_date").alias("wm_latest"), F.col("status").alias("wm_status"))
    return P.override_dates(P.plan(tickers.join(marks, "instrument_id", "left"), cfg, F.lit(today)), start, end, cfg.stream.batch_size_days)


COUNTS = ("landed", "written", "amended", "unchanged", "rejected")


def report(plans: DataFrame, by_symbol: DataFrame | None = None, failures: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """One row for each planned symbol: mode, bars landed, written, amended, unchanged and rejected, failed chunks, status, error.

    The status is skipped (nothing to do); failed (an error, and no bar);
    partial (an error, but bars of other chunks); no_data; or success, also if
    all bars were known or rejected.
    """
    out = plans.select("symbol", "mode")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]
    out = out.join(by_symbol, "symbol", "left").select("symbol", "mode", *counts) if by_symbol is not None else out.select("symbol", "mode", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    none = F.lit(None).cast("string")
    errors, n_failed = none, F.lit(0).cast("long")
    if failures is not None:
        out, errors = out.join(failures.groupBy("symbol").agg(F.min("error").alias("__given")), "symbol", "left"), F.col("__given")
    if failed is not None:
        by_chunk = failed.groupBy("symbol").agg(F.min_by("error", F.struct("chunk_start", "interval")).alias("__first"), F.count("*").alias("__n"))
        out = out.join(by_chunk, "symbol", "left")
        errors, n_failed = F.coalesce(errors, "__first"), F.coalesce("__n", F.lit(0))
    due, some = F.col("mode") != "NO_OP", F.col("landed") > 0
    status = F.when(~due, "skipped").when(errors.isNotNull(), F.when(some, "partial").otherwise("failed")).when(some, "success").otherwise("no_data")
    return out.select("symbol", "mode", *COUNTS, n_failed.alias("failed_chunks"), status.alias("status"), F.when(due, errors).alias("error"))


def summarise(report: DataFrame) -> DataFrame:
    """One row of totals over a report. Skipped symbols and those without data did what was asked of them; 100 per cent of none."""
    n = lambda *of: F.count_if(F.col("status").isin(*of))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*COUNTS, "failed_chunks")]
    out = report.agg(
        F.count("*").alias("total_symbols"), n("success", "partial").alias("successful_symbols"), n("partial").alias("partial_symbols"),
        n("skipped", "no_data").alias("skipped_symbols"), n("failed").alias("failed_symbols"), *sums,
    )
    ok = (F.col("total_symbols") - F.col("failed_symbols")) / F.greatest("total_symbols", F.lit(1)) * 100
    return out.withColumn("success_rate_pct", F.when(F.col("total_symbols") == 0, 100.0).otherwise(F.bround(ok, 1)))


def run_job(
    store: TableStore, landed: dict[str, str | Fetch], tickers: DataFrame, cfg: P.PlanConfig, today: Column | date, batch: str, version: str = "unknown", start: date | None = None, end: date | None = None,
    failures: DataFrame | None = None, dry_run: bool = False, now: Column | None = None,
) -> Run:
    """Plan all tickers, get what their ranges ask for from the chosen provider, and ingest it.

    ``landed`` gives each provider's path of payloads, or a function that gets
    a chunk's payloads (``ChunkFiles`` for landed chunks): it is called once for
    each chunk of the plan, and a chunk that fails costs only itself. A primary
    source that isn't healthy is replaced by the fallback for the whole run.
    ``failures`` (symbol, error) are symbols whose fetch is known to have
    failed. A symbol that failed without any bar counts against its watermark;
    none stops the others. A batch may be run again.
    """
    spark = store.spark
    plans = written(plan_run(store, tickers, cfg, today, start, end), "plans")
    requests = P.chunks(plans, cfg.stream.batch_size_days)
    if dry_run:
        return Run(plans, requests, None, None, report(plans), tables=(plans,))
    name = providers.choose(spark, landed)
    due, source, tables = plans.where("mode != 'NO_OP'"), landed[name], (plans,)
    given = None if failures is None else failures.join(due.select("symbol"), "symbol", "left_semi")
    failed, lost = None, given
    if callable(source):
        got = written(fetch_chunks(requests, source, cfg.stream.intervals), "chunks")
        tables, failed = (plans, got), failed_chunks(got)
        bars = providers.chunk_bars(got, name)
        lost = failed.select("symbol", "error") if given is None else failed.select("symbol", "error").unionByName(given.select("symbol", "error"))
    else:
        bars = planned(providers.read_bars(spark, source, name), plans).drop("mode", "ingestion_type")
    done = ingest_batch(store, bars, cfg.stream, batch, version, tickers, now, plans=due, failures=lost)
    made = report(plans, done.by_symbol, given, failed)
    return Run(plans, requests, name, summarise(made), made, failed, done, tables)
