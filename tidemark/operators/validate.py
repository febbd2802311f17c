"""Batch validation: every bar gets its outcome, and the batch its counts and audit rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.config import Stream
from tidemark.functions import metrics, rules

OUTCOMES = ("clean", "flagged", "rejected")


def validate(bars: DataFrame, stream: Stream | None = None) -> DataFrame:
    """Add ``fired`` (all rules that fire, in order), ``outcome`` and ``deciding_rule``.

    Any critical rule rejects, and the first one decides; else any rule flags.
    Without a stream the shared rules alone hold. One projection, no shuffle.
    """
    read = rules.with_read(bars)
    found = read.withColumn("fired", rules.fired(read, rules.rule_set(stream))).drop(*[c for c in read.columns if c.startswith(rules.READ)])
    critical = F.filter("fired", lambda x: x["severity"] == "critical")
    outcome = F.when(F.size(critical) > 0, "rejected").when(F.size("fired") > 0, "flagged").otherwise("clean")
    return found.withColumn("outcome", outcome).withColumn("deciding_rule", F.when(F.size(critical) > 0, F.get(critical, F.lit(0))["rule"]))


def writable(validated: DataFrame) -> DataFrame:
    """Clean and flagged bars."""
    return validated.where("outcome != 'rejected'")


def enrich(validated: DataFrame, batch_id: str, pipeline_version: str, ingestion_type: str | Column = "scheduled", now: Column | None = None, nullable: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Stamp the audit columns; versions and amendment marks that a bar already has stay."""
    stamp = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    keep = lambda n, default: F.coalesce(S.field(validated, n), default)
    columns = {
        "batch_id": F.lit(batch_id),
        "pipeline_version": F.lit(pipeline_version),
        "ingestion_type": F.lit(ingestion_type),
        "ingested_at": keep("ingested_at", stamp),
        "ingested_by": keep("ingested_by", F.lit("tidemark")),
        "data_as_of": keep("data_as_of", stamp),
        "record_version": keep("record_version", F.lit(1)),
        "is_amended": keep("is_amended", F.lit(False)),
        "fetch_attempt_count": keep("fetch_attempt_count", F.lit(1)),
        "currency": keep("currency", F.lit("USD")),
        "market_session": keep("market_session", F.lit("regular")),
        "dividend_amount": keep("dividend_amount", F.lit(0.0)),
        "unadj_close": keep("unadj_close", S.field(validated, "close")),
        "data_quality_flag": F.col("outcome") == "flagged",
        "data_quality_reasons": reasons_json(),
        "data_completeness_pct": metrics.completeness_by_source(validated, nullable or {}),
    }
    return validated.withColumns(columns).withColumn("has_corporate_action", F.coalesce(S.field(validated, "has_corporate_action"), metrics.has_corporate_action(validated)))


def reasons_json() -> Column:
    """Names of the rules that fired, as a JSON array."""
    return F.to_json(F.transform("fired", lambda x: x["rule"]))


def rejected_records(validated: DataFrame, batch_id: str = "", pipeline_version: str = "", now: Column | None = None) -> DataFrame:
    """Quarantine rows of the rejected bars, the whole bar as JSON with its nulls."""
    raw = F.to_json(F.struct(*[c for c in validated.columns if c not in ("fired", "outcome", "deciding_rule")]), {"ignoreNullFields": "false"})
    first = F.get(F.filter("fired", lambda x: x["severity"] == "critical"), F.lit(0))
    stamp = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = validated.where("outcome = 'rejected'").select(
        "symbol", F.col("date").cast("string").alias("date"), "interval", "source", F.lit(batch_id).alias("batch_id"), F.col("deciding_rule").alias("rejected_rule"),
        first["message"].alias("rejection_reason"), raw.alias("raw_record"), stamp.alias("rejected_at"),
        *[F.col(c).alias(f"raw_{c}") for c in ("open", "high", "low", "close", "volume")], F.lit(False).alias("reprocessed"), F.lit(pipeline_version).alias("pipeline_version"),
    )
    return S.conform(out, S.REJECT_SCHEMA)


def rejudged(rejects: DataFrame, stream: Stream | None = None) -> DataFrame:
    """Open rejects read back from their JSON as bars, validated by the rules as they are now.

    Beside the outcome stands ``reject``, the stored row. A reject whose JSON
    can't be read has no bar and is rejected again.
    """
    bars = rejects.where(~F.coalesce("reprocessed", F.lit(False))).select(F.struct("*").alias("reject"), F.from_json("raw_record", S.BARS_SCHEMA).alias("bar"))
    return validate(bars.select("bar.*", "reject"), stream)


def closed(rejects: DataFrame, judged: DataFrame, batch_id: str, now: Column | None = None) -> DataFrame:
    """All rejects, those that pass now marked as reprocessed by this batch; closed ones stay as they are.

    Equal rejects are judged alike, so rows are told apart by what they say.
    """
    key = ["symbol", "date", "interval", "batch_id", "rejected_rule", "raw_record"]
    stamp = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    passed = judged.where("outcome != 'rejected'").select(*[F.col(f"reject.{k}").alias(k) for k in key]).distinct().withColumn("__passed", F.lit(True)).alias("p")
    joined = rejects.alias("r").join(passed, reduce(and_, [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key]), "left")
    now_closed = F.coalesce("__passed", F.lit(False)) & ~F.coalesce("r.reprocessed", F.lit(False))
    marks = {"reprocessed": now_closed | F.coalesce("r.reprocessed", F.lit(False)), "reprocessed_at": F.when(now_closed, stamp).otherwise(F.col("r.reprocessed_at")),
             "reprocessed_batch": F.when(now_closed, F.lit(batch_id)).otherwise(F.col("r.reprocessed_batch"))}
    return joined.select(*[(marks[c] if c in marks else F.col(f"r.{c}")).alias(c) for c in rejects.columns])


def compact(validated: DataFrame, by: tuple[str, ...] = ("symbol", "interval")) -> DataFrame:
    """The summary of each batch as one JSON text without any bar: counts, rates, and rules that fired with how often."""
    counts = summary(validated, by)
    fired = validated.select(*by, F.explode("fired.rule").alias("rule")).groupBy(*by, "rule").agg(F.count("*").alias("n"))
    hits = fired.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule", "n")))).alias("rule_hits"))
    same = reduce(and_, [F.col(f"c.{b}").eqNullSafe(F.col(f"h.{b}")) for b in by])
    out = counts.alias("c").join(hits.alias("h"), same, "left").select("c.*", F.coalesce("rule_hits", F.map_from_entries(F.array().cast("array<struct<rule:string,n:bigint>>"))).alias("rule_hits"))
    return out.select(*by, F.to_json(F.struct(*[c for c in out.columns if c not in by])).alias("summary"))


def audit_log(validated: DataFrame) -> DataFrame:
    """One row for each rule that decided: the critical ones of a rejected bar, all of a flagged one."""
    deciding = F.filter("fired", lambda x: (F.col("outcome") == "flagged") | (x["severity"] == "critical"))
    return validated.select("symbol", "date", "interval", "outcome", F.explode(deciding).alias("x")).select("symbol", "date", "interval", F.col("x.rule").alias("rule"), F.col("x.severity").alias("severity"), "outcome")


def rule_hits(validated: DataFrame) -> DataFrame:
    """How often each rule fired."""
    return validated.select(F.explode("fired").alias("x")).groupBy(F.col("x.rule").alias("rule"), F.col("x.severity").alias("severity")).agg(F.count("*").alias("hits"))


def summary(validated: DataFrame, by: tuple[str, ...] = ("symbol", "interval")) -> DataFrame:
    """Counts and rates of each batch; without ``by``, one row, also for an empty batch (100 and 0 per cent)."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    counts = validated.groupBy(*by).agg(F.count("*").alias("total_input"), n("clean").alias("total_passed"), n("flagged").alias("total_flagged"), n("rejected").alias("total_rejected"))
    rate = lambda c, empty: F.when(F.col("total_input") == 0, F.lit(empty)).otherwise(F.bround(F.col(c) / F.greatest("total_input", F.lit(1)) * 100, 1))
    return counts.withColumn("pass_rate_pct", rate("total_passed", 100.0)).withColumn("rejection_rate_pct", rate("total_rejected", 0.0))


def counters(stream: Stream | None = None) -> list[Column]:
    """Counts of a batch as aggregates of validated bars: outcomes, dates, and how often each rule fired as ``hits_<rule>``."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    totals = [F.count(F.lit(1)).alias("total_input"), n("clean").alias("total_passed"), n("flagged").alias("total_flagged"), n("rejected").alias("total_rejected")]
    days = [F.min("date").alias("first_date"), F.max("date").alias("last_date")]
    hit = lambda name: F.count_if(F.exists("fired", lambda x: x["rule"] == name)).alias(f"hits_{name}")
    return totals + days + [hit(r.name) for r in rules.rule_set(stream) if r.action != "alert"]


def order_alerts(bars: DataFrame, stream: Stream) -> DataFrame:
    """(symbol, rule, detail): what a stream's rules on the order of bars find in a batch, by the stream's own limits.

    These rules look at neighbours and so never fire on a single record.
    """
    from tidemark.operators import sequence as Q

    limits = {r.name: r.threshold for r in rules.rule_set(stream)}
    found = []
    if "max_consecutive_missing_days" in limits:
        alerts = continuity_alerts(bars, int(limits["max_consecutive_missing_days"]))
        found.append(alerts.select("symbol", F.lit("max_consecutive_missing_days").alias("rule"), F.concat_ws(" ", "gap_start", "gap_end", "missing_days").alias("detail")))
    if "consistent_bar_spacing" in limits:
        made = Q.spacing_errors(bars, "bar_time_utc")
        found.append(made.select("symbol", F.lit("consistent_bar_spacing").alias("rule"), F.concat_ws(" ", "bar_time_utc", "gap_minutes").alias("detail")))
    if "consecutive_zero_volume" in limits:
        made = Q.zero_volume_runs(bars, int(limits["consecutive_zero_volume"] or 3), "bar_time_utc")
        found.append(made.select("symbol", F.lit("consecutive_zero_volume").alias("rule"), F.concat_ws(" ", "run_start", "run_end", "n_bars").alias("detail")))
    if "tick_price_spike" in limits:
        made = Q.price_spikes(bars, float(limits["tick_price_spike"] or 3.0), order="bar_time_utc")
        found.append(made.select("symbol", F.lit("tick_price_spike").alias("rule"), F.concat_ws(" ", "bar_time_utc", "close").alias("detail")))
    out = found[0] if found else bars.limit(0).select("symbol", F.lit("").alias("rule"), F.lit("").alias("detail"))
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def continuity_alerts(bars: DataFrame, limit: int = 5) -> DataFrame:
    """Daily symbols whose longest gap leaves more than ``limit`` trading days out; the first of equal gaps.

    A gap of more than three days counts its days less a weekend's two.
    """
    order = W.partitionBy("symbol").orderBy("date")
    days = bars.where("interval = '1d' and date is not null").select("symbol", "date").distinct()
    gaps = days.select("symbol", F.lag("date").over(order).alias("gap_start"), F.col("date").alias("gap_end")).withColumn("diff", F.date_diff("gap_end", "gap_start"))
    gaps = gaps.where("diff > 3").withColumn("missing_days", F.col("diff") - 2)
    best = F.max_by(F.struct("gap_start", "gap_end", "missing_days"), F.struct("missing_days", -F.unix_date("gap_start")))
    return gaps.groupBy("symbol").agg(best.alias("x")).select("symbol", "x.*").where(F.col("missing_days") > limit)
