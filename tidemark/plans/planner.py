"""Fetch planning: one projection over instruments, watermarks and configuration."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Stream
from tidemark.functions.calendar import last_trading_day

# Ingestion type of each mode.
INGESTION_TYPE = {
    "FORCE_RELOAD": "backfill", "RESTATEMENT": "amendment", "EXPLICIT_DATE_RANGE": "backfill", "HISTORY_EXTENSION": "backfill",
    "INITIAL_LOAD": "backfill", "GAP_FILL": "backfill", "NO_OP": "scheduled", "INCREMENTAL": "scheduled",
}


@dataclass(frozen=True)
class Override:
    """A special run: switched on, for these symbols (none means all), over this range."""

    enabled: bool = False
    symbols: tuple[str, ...] = ()
    start: date | None = None
    end: date | None = None
    confirm: bool = False

    def covers(self, symbol: Column) -> Column:
        if not self.enabled:
            return F.lit(False)
        return in_scope(symbol, self.symbols)


@dataclass(frozen=True)
class PlanConfig:
    stream: Stream
    force_reload: Override = field(default_factory=Override)
    restatement: Override = field(default_factory=Override)
    date_range: Override = field(default_factory=Override)
    history_extension: Override = field(default_factory=Override)


def in_scope(symbol: Column, symbols: tuple[str, ...]) -> Column:
    """No list means every symbol."""
    return F.upper(symbol).isin(*[s.upper() for s in symbols]) if symbols else F.lit(True)


def initial_start(stream: Stream, today: Column, history: Column) -> Column:
    back = F.add_months(today, -12 * stream.lookback_years) if stream.lookback_years else F.date_sub(today, stream.lookback_days)
    return F.coalesce(history, back)


def plan(instruments: DataFrame, cfg: PlanConfig, today: Column) -> DataFrame:
    """One row for each instrument: mode, range, type, length and number of chunks.

    ``instruments`` carries symbol, history_start, and its watermark's
    wm_earliest, wm_latest, wm_status (null without one). The first mode that
    applies wins.
    """
    s, symbol = cfg.stream, F.col("symbol")
    earliest, latest = F.col("wm_earliest"), F.col("wm_latest")
    start = initial_start(s, today, F.col("history_start"))
    on = lambda d: F.lit(d).cast("date")
    extended = on(cfg.history_extension.start)
    cases = [
        ("NO_OP", F.col("wm_status") == "suspended", today, today),
        ("FORCE_RELOAD", cfg.force_reload.covers(symbol) & F.lit(cfg.force_reload.confirm), start, today),
        ("RESTATEMENT", cfg.restatement.covers(symbol), on(cfg.restatement.start), on(cfg.restatement.end)),
        ("EXPLICIT_DATE_RANGE", cfg.date_range.covers(symbol), on(cfg.date_range.start), on(cfg.date_range.end)),
        ("HISTORY_EXTENSION", cfg.history_extension.covers(symbol) & (extended < earliest), extended, F.date_sub(earliest, 1)),
        ("INITIAL_LOAD", latest.isNull(), start, today),
        ("GAP_FILL", F.date_diff(today, latest) > s.max_gap_days, F.date_add(latest, 1), today),
        ("NO_OP", latest >= last_trading_day(today), today, today),
        ("INCREMENTAL", F.lit(True), F.greatest(F.date_sub(latest, s.amendment_buffer_days), earliest), today),
    ]
    chosen: Column | None = None
    for mode, when, a, z in cases:
        row = F.struct(F.lit(mode).alias("mode"), a.alias("start_date"), z.alias("end_date"))
        chosen = F.when(when, row) if chosen is None else chosen.when(when, row)
    out = instruments.withColumn("p", chosen).select("symbol", "p.mode", "p.start_date", "p.end_date")
    return _derived(out, s.batch_size_days)


def _derived(plans: DataFrame, days: int) -> DataFrame:
    """What follows from a plan's mode and range."""
    types = F.create_map(*[F.lit(x) for kv in INGESTION_TYPE.items() for x in kv])
    length = F.date_diff("end_date", "start_date") + 1
    return plans.withColumns({
        "ingestion_type": types[F.col("mode")],
        "is_backfill": types[F.col("mode")] == "backfill",
        "is_amendment_run": F.col("mode") == "RESTATEMENT",
        "date_range_days": length,
        "estimated_batches": F.greatest(F.lit(1), F.floor(length / days)).cast("int"),
    })


def override_dates(plans: DataFrame, start: date | None, end: date | None, days: int = 30) -> DataFrame:
    """Dates given by hand beat every mode, if both are; ``days`` is the stream's chunk."""
    if start is None or end is None:
        return plans
    return _derived(plans.withColumns({"mode": F.lit("EXPLICIT_DATE_RANGE"), "start_date": F.lit(start), "end_date": F.lit(end)}), days)


def chunks(plans: DataFrame, days: int) -> DataFrame:
    """The pieces of at most ``days`` days in which a plan is fetched; none for NO_OP."""
    steps = F.sequence(F.lit(0), F.floor(F.date_diff("end_date", "start_date") / days).cast("int"))
    out = plans.where("mode != 'NO_OP' and start_date <= end_date").select("symbol", "mode", "end_date", "start_date", F.explode(steps).alias("chunk"))
    first = F.date_add("start_date", (F.col("chunk") * days).cast("int"))
    return out.select("symbol", "mode", F.col("chunk").cast("int").alias("chunk"), first.alias("chunk_start"), F.least(F.date_add(first, days - 1), "end_date").alias("chunk_end"))
