"""Queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as X
from tidemark import schemas as S
from tidemark.catalogue_sql import ORACLE_SQL
from tidemark.config import STREAMS, YAHOO_NULLABLE
from tidemark.functions import calendar as C
from tidemark.functions import metrics as M
from tidemark.functions import rules as R
from tidemark.operators import classify as K
from tidemark.operators import constraints as G
from tidemark.operators import control as O
from tidemark.operators import sequence as Q
from tidemark.operators import universe as U
from tidemark.operators import validate as V
from tidemark.operators import watermark as H
from tidemark.plans import job as J
from tidemark.operators._scratch import folder
from tidemark.plans import planner as P
from tidemark.plans.run import run_job
from tidemark.sources import chunks as N
from tidemark.sources import etf, files, listings, providers
from tidemark.store import TableStore
from tidemark.streaming.bars import bars_from_ticks, change_counts, follow

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _day(text: str):
    return F.lit(text).cast("date")


@query
def bars_daily(spark, d):
    return X.daily_bars(spark, d)


@query
def bars_intraday_1h(spark, d):
    return bars_from_ticks(X.ticks(spark, d)).withColumn("bar_time", F.col("bar_time").cast("string"))


@query
def bar_metrics(spark, d):
    bars = X.daily_bars(spark, d).drop("prev_close")
    bars = M.with_prev_close(bars.where("close is not null"))
    return bars.select("symbol", "date", M.price_range(bars).alias("price_range"), M.daily_return_pct(bars).alias("daily_return_pct"), M.gap_pct(bars).alias("gap_pct"), M.is_gap_up(bars).alias("is_gap_up"), M.is_gap_down(bars).alias("is_gap_down"))


@query
def rule_hits(spark, d):
    return V.rule_hits(V.validate(X.daily_bars(spark, d)))


@query
def rule_hits_defects(spark, d):
    """Bars with defects that the plain ones don't have, so that every rule fires."""
    m = F.col("volume") % 9
    bars = X.daily_bars(spark, d).withColumns({
        "low": F.when(m == 0, F.col("open") + 0.25).when(m == 1, F.col("close") + 0.25).when(m == 2, -1.0).otherwise(F.col("low")),
        "prev_close": F.when(m == 3, 0.0).otherwise(F.col("prev_close")),
        "pre_market_volume": F.when(m == 4, -1).otherwise(5).cast("long"),
        "is_amended": m == 5,
        "fetch_duration_ms": F.when(m == 6, 30001).otherwise(30000).cast("long"),
    })
    wanted = ("low_lte_open", "low_lte_close", "price_positive", "prev_close_positive", "pre_market_volume_non_negative", "amended_record_detected", "fetch_duration_threshold")
    return V.rule_hits(V.validate(bars)).where(F.col("rule").isin(*wanted))


def _override(spark, d):
    return P.override_dates(_plans(spark, d), date(2000, 2, 1), date(2000, 4, 30), STREAMS["daily"].batch_size_days)


@query
def plan_override(spark, d):
    return _override(spark, d)


@query
def order_alerts(spark, d):
    """Rules on the order of bars over hourly bars, by the limits of the streams that have them."""
    made = bars_from_ticks(X.ticks(spark, d))
    bars = made.withColumns({"bar_time_utc": F.col("bar_time").cast("string"), "date": F.to_date("bar_time"), "volume": F.when(F.col("volume") % 3 == 0, 0).otherwise(F.col("volume"))})
    both = V.order_alerts(bars, STREAMS["intraday"]).unionAll(V.order_alerts(bars, STREAMS["tick"]))
    both = both.unionAll(V.order_alerts(X.daily_bars(spark, d), replace(STREAMS["daily"], thresholds={"max_consecutive_missing_days": 2.0})))
    return both.groupBy("symbol", "rule").agg(F.count("*").alias("n"))


@query
def validation_outcome(spark, d):
    return V.validate(X.daily_bars(spark, d)).select("symbol", "date", "outcome", "deciding_rule")


@query
def validation_summary(spark, d):
    return V.summary(V.validate(X.daily_bars(spark, d)))


@query
def writable_bars(spark, d):
    return V.writable(V.validate(X.daily_bars(spark, d))).groupBy("symbol", "outcome").agg(F.count("*").alias("n"))


@query
def rejected_records(spark, d):
    made = V.rejected_records(V.validate(X.daily_bars(spark, d)), "b1", "v1", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    raw = F.from_json("raw_record", S.BARS_SCHEMA)  # how a number is written differs between engines, what it says doesn't
    made = made.withColumns({"raw_vwap": raw["vwap"], "raw_trade_count": raw["trade_count"], "has_reason": F.length("rejection_reason") > 0})
    return made.select("symbol", "date", "interval", "source", "batch_id", "rejected_rule", "rejected_at", "has_reason", "raw_vwap", "raw_trade_count", "raw_open", "raw_high", "raw_low", "raw_close", "raw_volume", "reprocessed", "pipeline_version")


@query
def flagged_reasons(spark, d):
    made = V.validate(X.daily_bars(spark, d)).where("outcome = 'flagged'")
    return made.select("symbol", "date", V.reasons_json().alias("data_quality_reasons"))


@query
def audit_log(spark, d):
    return V.audit_log(V.validate(X.daily_bars(spark, d)))


@query
def enriched_bars(spark, d):
    made = V.enrich(V.writable(V.validate(X.daily_bars(spark, d))), "b1", "v1", now=F.lit("2026-01-02 03:04:05").cast("timestamp"))
    return made.select("symbol", "date", "batch_id", "ingestion_type", "ingested_at", "record_version", "is_amended", "currency", "unadj_close", "has_corporate_action", "data_quality_flag", "data_completeness_pct")


@query
def completeness(spark, d):
    bars = X.daily_bars(spark, d)
    return bars.select("symbol", "date", M.completeness_pct(bars).alias("pct"), M.completeness_pct(bars, YAHOO_NULLABLE).alias("pct_yahoo"))


@query
def continuity_alerts(spark, d):
    return V.continuity_alerts(X.daily_bars(spark, d), 2)


@query
def weekend_rule(spark, d):
    checked = V.validate(X.daily_bars(spark, d), STREAMS["daily"])
    return V.rule_hits(checked).where("rule = 'no_weekend_dates'")


@query
def corp_action_consistency(spark, d):
    v = F.col("volume")
    bars = X.daily_bars(spark, d).withColumns({
        "is_ex_split_date": v % 7 == 0, "split_factor": F.when(v % 14 == 0, 0.25), "is_ex_dividend_date": v % 3 == 0,
        "dividend_amount": F.when(v % 5 == 0, 0.5).otherwise(0.0), "has_corporate_action": v % 11 == 0,
    })
    fires = R.REGISTRY["corporate_action_consistency"](R.Bar(bars), None).isNotNull()
    return bars.select("symbol", "date", fires.alias("inconsistent"), M.has_corporate_action(bars).alias("derived_action"))


@query
def record_invariants(spark, d):
    bars = X.daily_bars(spark, d).withColumns({"batch_id": F.lit("b1"), "pipeline_version": F.when(F.col("volume") % 10 == 0, " ").otherwise("v1"), "interval": F.when(F.col("volume") % 9 == 0, "1h").otherwise("1d")})
    return bars.select(F.explode(S.broken_invariants(bars)).alias("broken")).groupBy("broken").agg(F.count("*").alias("n"))


def _order_days(spark, d):
    """Days with orders, moved by 28 years into the calendar: weekdays stay what they were."""
    return X.table(spark, d, "orders").select(F.add_months(F.to_date("o_orderdate"), 336).alias("date")).distinct()


@query
def trading_days(spark, d):
    return _order_days(spark, d).where(C.is_trading_day(F.col("date")))


@query
def trading_day_counts(spark, d):
    """Trading days between each customer's first and last order."""
    own = X.table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("z"))
    own = own.select("o_custkey", F.add_months("a", 336).alias("a"), F.add_months("z", 336).alias("z"))
    return own.select("o_custkey", "a", "z", C.trading_day_count(F.col("a"), F.col("z")).alias("n"))


@query
def last_trading_day(spark, d):
    return _order_days(spark, d).select("date", C.last_trading_day(F.col("date")).alias("last_trading_day"))


@query
def missing_trading_days(spark, d):
    bars = X.daily_bars(spark, d).select("symbol", F.add_months("date", 240).alias("date"))
    return Q.missing_trading_days(bars)


@query
def market_hours(spark, d):
    events = X.table(spark, d, "events")
    return events.groupBy("event_type").agg(F.count_if(C.is_market_open(F.col("ts").cast("timestamp"))).alias("n_open"), F.count("*").alias("n"))


def _classified(spark, d):
    bars = X.daily_bars(spark, d)
    return K.classify(X.incoming_bars(bars), X.stored_bars(bars))


@query
def classify_batch(spark, d):
    return _classified(spark, d).select("symbol", "date", "action")


@query
def amend_records(spark, d):
    return K.amend(_classified(spark, d), "b1").select("symbol", "date", "close", "record_version", "supersedes_batch", "batch_id", "is_amended", "amendment_reason")


@query
def amend_fields(spark, d):
    stored = X.stored_bars(X.daily_bars(spark, d))
    changes = stored.where("volume % 100 = 0").select("symbol", "date", "interval", F.lit(0.5).alias("split_factor"), (F.col("volume") + 1).alias("volume"))
    made = K.amend_fields(stored.withColumn("split_factor", F.lit(None).cast("double")), changes, "b2", "split_adjustment")
    return made.select("symbol", "date", "volume", "split_factor", "record_version", "supersedes_batch", "amendment_reason", "has_corporate_action")


@query
def silver_latest(spark, d):
    stored = X.stored_bars(X.daily_bars(spark, d))
    amended = K.amend(_classified(spark, d), "b1").select("symbol", "date", "interval", "close", "record_version", "batch_id")
    both = stored.select(*amended.columns).unionAll(amended)
    return K.latest(both).select("symbol", "date", "close", "record_version", "batch_id")


@query
def record_counts(spark, d):
    return K.record_counts(X.daily_bars(spark, d))


@query
def source_fallback(spark, d):
    bars = X.daily_bars(spark, d)
    return K.first_non_empty([bars.where("volume % 3 != 0"), bars.withColumn("source", F.lit("fallback"))]).select("symbol", "date", "source", "close")


def _planned_instruments(spark, d):
    k = F.col("instrument_id")
    marks = X.watermarks(X.daily_bars(spark, d)).select(
        "instrument_id", F.col("earliest_date").alias("wm_earliest"), F.date_add("latest_date", ((k % 4) * 55 + F.when(k % 5 == 0, 120).otherwise(0)).cast("int")).alias("wm_latest"), F.col("status").alias("wm_status")
    )
    each = X.suppliers(spark, d).select("instrument_id", "symbol", F.when(k % 3 == 0, _day("1999-05-01")).alias("history_start"))
    return each.join(marks, "instrument_id", "left")


def _plans(spark, d):
    cfg = P.PlanConfig(
        STREAMS["daily"], force_reload=P.Override(True, ("S1", "s30"), confirm=True), restatement=P.Override(True, ("S2", "S7"), date(2000, 1, 3), date(2000, 3, 3)),
        date_range=P.Override(True, ("S2", "S6"), date(1999, 6, 1), date(1999, 6, 30)), history_extension=P.Override(True, ("S8", "S40"), date(1994, 1, 1)),
    )
    return P.plan(_planned_instruments(spark, d), cfg, _day("2001-06-18"))


@query
def plan_modes(spark, d):
    return _plans(spark, d)


@query
def plan_chunks(spark, d):
    return P.chunks(_plans(spark, d), STREAMS["daily"].batch_size_days)


def _marks_after(spark, d):
    bars = X.daily_bars(spark, d)
    k = F.substring("symbol", 2, 9).cast("long")
    made = X.incoming_bars(bars).withColumn("instrument_id", F.when(k < 5, k + 100).otherwise(k)).where("instrument_id > 7")
    made = H.bounds(made, ("instrument_id",)).withColumns({"stream": F.lit("daily"), "batch_id": F.lit("b1"), "mode": F.lit("INCREMENTAL"), "run_status": F.when(F.col("instrument_id") % 4 == 0, "failed").otherwise("success")})
    return H.upsert(X.watermarks(bars), made, now=F.lit("t1"))


@query
def watermark_upsert(spark, d):
    return _marks_after(spark, d)


@query
def watermark_failures(spark, d):
    return H.find(_marks_after(spark, d), "daily").groupBy("status").agg(F.count("*").alias("n"), F.sum("consecutive_failures").alias("failures"))


@query
def watermark_by_symbol(spark, d):
    bars = X.daily_bars(spark, d)
    tag = lambda df, b, m: df.withColumns({"batch_id": F.lit(b), "mode": F.lit(m)})
    return H.upsert_by_symbol(tag(H.bounds(X.stored_bars(bars)), "b0", "INITIAL_LOAD"), tag(H.bounds(X.incoming_bars(bars).where("symbol != 'S3'")), "b1", "INCREMENTAL"))


@query
def universe_active(spark, d):
    return U.active(X.feeds(spark, d), X.listings(spark, d), X.instruments(spark, d)).select("instrument_id", "symbol", "asset_class", "exchange_mic", "batch_group", "priority")


@query
def universe_filtered(spark, d):
    return U.active(X.feeds(spark, d), X.listings(spark, d), X.instruments(spark, d), ("s1", "S5", "S10", "S15"), ("etf",)).select("instrument_id", "symbol", "asset_class")


def _tickers(spark, d):
    k = F.col("instrument_id")
    return X.suppliers(spark, d).select(
        "symbol", F.when(k % 5 == 0, "etf").otherwise("equity").alias("asset_class"), F.when(k % 2 == 0, "Tech").otherwise("Health").alias("sector"), (k % 6 != 0).alias("active"),
        F.when(k % 3 == 0, F.date_add(_day("1990-01-01"), k.cast("int"))).alias("history_start"), F.date_add(_day("1980-01-01"), k.cast("int")).alias("ipo_date"),
    )


@query
def universe_lookup(spark, d):
    t = _tickers(spark, d)
    return U.lookup(t, "s7").unionAll(U.lookup(t, "S9")).select("symbol", U.effective_history_start(t).alias("effective_history_start"))


@query
def ticker_filter(spark, d):
    return U.select_tickers(_tickers(spark, d), sectors=("tech",), asset_classes=("EQUITY",)).select("symbol", "sector", "asset_class")


@query
def ticker_counts(spark, d):
    t = _tickers(spark, d)
    each = t.select(F.col("active").cast("long").alias("n_active"), F.lit(1).alias("n_total"), F.lit(0).alias("n_symbols"))
    each = each.unionAll(U.symbols(t).select(F.lit(0).cast("long"), F.lit(0), F.lit(1)))
    return each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in each.columns])


@query
def listing_parse_nasdaq(spark, d):
    return listings.parse_nasdaq(X.nasdaq_lines(spark, d)).drop("line_no")


@query
def listing_parse_other(spark, d):
    return listings.parse_other(X.other_lines(spark, d)).drop("line_no")


@query
def listing_merge(spark, d):
    halved = lambda df, shift: df.withColumn("symbol", F.concat(F.lit("P"), (F.floor(F.substring("symbol", 2, 18).cast("long") / 2) + shift).cast("string")))
    a, b = listings.parse_nasdaq(X.nasdaq_lines(spark, d)), listings.parse_other(X.other_lines(spark, d))
    return listings.merge(halved(a, 0), halved(b, 300)).select("symbol", "company_name", "exchange", "exchange_mic", "asset_class", "source_rank")


def _holdings(spark, d):
    k = F.col("p_partkey")
    base = X.table(spark, d, "part").select(
        k, F.when(k % 100 == 0, "Cash").otherwise(F.concat(F.lit(" p"), k.cast("string"), F.lit(" "))).alias("symbol"), F.col("p_name").alias("company_name"),
        F.when(k % 7 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("%"))).alias("weight_text"),
    )
    funds = [(etf.EtfFile("SPY", "SP500", 0), 2), (etf.EtfFile("QQQ", "NDX100", 1), 3), (etf.EtfFile("IWM", "R2K", 2), 5)]
    return etf.union_of([(cfg, base.where(k % n == 0).drop("p_partkey")) for cfg, n in funds])


@query
def etf_merge(spark, d):
    made = etf.merge(_holdings(spark, d))
    return made.select("symbol", F.array_join("universe_codes", ",").alias("universe_codes"), "weight", "company_name", "is_active")


@query
def symbol_overlay(spark, d):
    base = listings.parse_nasdaq(X.nasdaq_lines(spark, d)).select("symbol", "company_name", "exchange_mic")
    top = etf.merge(_holdings(spark, d)).select("symbol", F.lit("overlaid").alias("company_name"), "weight")
    return U.overlay(base, top, ("company_name", "exchange_mic", "weight"))


def _incoming_symbols(spark, d):
    s = X.suppliers(spark, d)
    return s.select("symbol").unionAll(s.where("instrument_id % 4 = 0").select(F.concat(F.lit("X"), F.col("instrument_id").cast("string"))))


@query
def universe_new(spark, d):
    return U.new_symbols(_incoming_symbols(spark, d), X.listings(spark, d))


@query
def universe_to_enrich(spark, d):
    current = X.listings(spark, d).where("is_current").join(X.instruments(spark, d), "instrument_id")
    members = current.join(X.memberships(spark, d).select("instrument_id").distinct(), "instrument_id").select("symbol")
    members = members.unionAll(_incoming_symbols(spark, d).where("symbol like 'X%'"))
    return U.to_enrich(_incoming_symbols(spark, d), members, current.select("symbol", "figi"))


@query
def enrich_figi(spark, d):
    current = X.listings(spark, d).where("is_current").join(X.instruments(spark, d), "instrument_id").select("symbol", "figi", F.lit(None).cast("string").alias("isin"))
    k = F.col("instrument_id")
    hits = X.suppliers(spark, d).where("instrument_id % 3 != 0")
    one = lambda pos, tag: hits.select("symbol", F.lit(pos).alias("pos"), F.concat(F.lit(tag), k.cast("string")).alias("figi"), F.concat(F.lit("US"), k.cast("string")).alias("isin"))
    return U.enrich_figi(current, one(1, "LATE").unionAll(one(0, "MAP"))).select("symbol", "figi", "isin", "block", "batch_no")


@query
def enrich_con_id(spark, d):
    k = F.col("instrument_id")
    rows = X.instruments(spark, d).withColumns({"symbol": F.concat(F.lit("S"), k.cast("string")), "con_id": F.when(k % 4 == 0, k)})
    one = lambda pos, kind, c: X.suppliers(spark, d).select("symbol", F.lit(kind).alias("sec_type"), F.lit(pos).alias("pos"), c.cast("long").alias("con_id"))
    found = one(0, "STK", F.when(k % 2 == 0, k + 1000)).unionAll(one(1, "STK", k + 2000)).unionAll(one(0, "ETF", k + 3000))
    return U.enrich_con_id(rows, found).select("instrument_id", "asset_class", "con_id")


@query
def con_id_cache(spark, d):
    k = F.col("instrument_id")
    s = X.suppliers(spark, d)
    cache = s.where("instrument_id % 3 = 0").select("symbol", (k + 5000).cast("long").alias("con_id"))
    one = lambda pos, c: s.select("symbol", F.lit(pos).alias("pos"), c.cast("long").alias("con_id"))
    contracts = one(0, F.when(k % 2 == 0, k + 1000)).unionAll(one(1, F.when(k % 5 != 0, k + 2000)))
    return U.resolve_con_ids(s, cache, contracts)


@query
def assign_ids(spark, d):
    return U.assign_ids(X.listings(spark, d).where("is_current").select("symbol", "exchange_mic"), "instrument_id", ("symbol",), 1000)


@query
def recover_ids(spark, d):
    rows = X.listings(spark, d).withColumn("exchange_mic", F.when(F.col("instrument_id") % 9 != 0, F.col("exchange_mic"))).select("symbol", "exchange_mic")
    return U.recover_ids(rows, X.listings(spark, d))


@query
def membership_new(spark, d):
    k = F.col("instrument_id")
    codes = F.array_compact(F.array(F.when(k % 2 == 0, "SP500"), F.when(k % 3 == 0, "NDX100"), F.when(k % 5 == 0, "R2K"), F.when(k % 7 == 0, "SP500")))
    return U.new_memberships(X.suppliers(spark, d).select("instrument_id", codes.alias("universe_codes")), X.memberships(spark, d))


@query
def feed_config_new(spark, d):
    return U.new_feeds(X.instruments(spark, d), X.feeds(spark, d).where("batch_group != 'D'")).select("instrument_id", "asset_class")


@query
def universe_summary(spark, d):
    return U.summary(X.instruments(spark, d), X.memberships(spark, d), X.feeds(spark, d))


@query
def universe_summary_distinct(spark, d):
    return U.summary(X.instruments(spark, d), X.memberships(spark, d), X.feeds(spark, d), distinct=True)


@query
def feed_report(spark, d):
    return U.feed_report(X.feeds(spark, d), X.listings(spark, d))


@query
def instrument_update(spark, d):
    return U.reclassify(X.instruments(spark, d), X.feeds(spark, d).where("priority = 1"))


@query
def listing_rename(spark, d):
    listing = X.listings(spark, d).withColumns({"valid_from": _day("2000-01-01"), "valid_to": F.lit(None).cast("date")})
    renames = X.suppliers(spark, d).where("instrument_id % 25 = 0").select(F.col("symbol").alias("old_symbol"), F.concat(F.lit("N"), F.col("instrument_id").cast("string")).alias("new_symbol"))
    return U.rename_listing(listing, renames, _day("2024-02-01"))


def _run(spark, d):
    bars = X.daily_bars(spark, d)
    checked = V.validate(X.incoming_bars(bars))
    return K.classify(V.writable(checked), X.stored_bars(bars)), checked.where("outcome = 'rejected'")


@query
def job_summary(spark, d):
    return J.run_summary(*_run(spark, d))


@query
def run_report(spark, d):
    return J.run_report(*_run(spark, d))


@query
def planned_bars(spark, d):
    return J.planned(X.daily_bars(spark, d), _plans(spark, d)).groupBy("symbol").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query
def table_tier(spark, d):
    parts = X.table(spark, d, "part").select(F.element_at(F.array(*map(F.lit, S.INTERVALS)), (F.col("p_partkey") % 6 + 1).cast("int")).alias("interval")).distinct()
    i = F.col("interval")
    return parts.select("interval", S.table_tier(i).alias("tier"), F.array_join(S.unique_key(i), ",").alias("unique_key"), S.is_intraday(i).alias("is_intraday"))


@query
def type_coercion(spark, d):
    o = X.table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        k.cast("string").alias("symbol"), F.when(k % 5 == 0, "2026-02-30").when(k % 7 == 0, "2026-6-1").otherwise(F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T01:02:03"))).alias("date"),
        F.when(k % 3 == 0, "abc").otherwise(F.concat(k.cast("string"), F.lit(".75"))).alias("volume"), F.when(k % 4 == 0, "x1").otherwise(k.cast("string")).alias("open"),
    )
    return S.conform(raw, S.BARS_SCHEMA).select("symbol", "date", "volume", "open", "close")


def _gateway_bars(spark, d):
    e, k = X.table(spark, d, "events"), F.col("event_id")
    return e.select(
        F.upper("event_type").alias("symbol"), F.when(k % 3 == 0, "1d").when(k % 3 == 1, "1h").otherwise("5m").alias("interval"), F.when(k % 50 != 0, F.unix_millis(F.col("ts").cast("timestamp"))).alias("t"),
        F.when(k % 60 == 0, 0.0).otherwise(F.col("value")).alias("o"), (F.col("value") + 1).alias("h"), (F.col("value") - 1).alias("l"), F.col("value").alias("c"), F.col("user_id").alias("v"),
    )


@query
def provider_map_ibkr(spark, d):
    return providers.map_gateway_bars(_gateway_bars(spark, d)).select("symbol", "date", "interval", "open", "high", "low", "close", "volume", "adj_close", "exchange", "bar_time_utc", "bar_time_eastern", "bar_end_time_utc", "timezone_source")


@query
def provider_map_yahoo(spark, d):
    e, k = X.table(spark, d, "events"), F.col("event_id")
    raw = e.select(
        F.upper("event_type").alias("symbol"), F.when(k % 2 == 0, "1d").otherwise("1h").alias("interval"), "ts", *[F.col("value").alias(c) for c in ("Open", "High", "Low", "Close")], F.col("user_id").alias("Volume"),
        F.when(k % 15 == 0, 0.75).otherwise(0.0).alias("Dividends"), F.when(k % 20 == 0, 4.0).otherwise(0.0).alias("Stock Splits"),
    )
    return providers.map_yahoo_rows(raw).select("symbol", "date", "interval", "open", "close", "volume", "split_factor", "dividend_amount", "dividend_type", "is_ex_dividend_date", "is_ex_split_date", "has_corporate_action", "bar_time_utc")


@query
def date_window(spark, d):
    return providers.between_dates(X.daily_bars(spark, d), _day("1999-01-01"), _day("1999-01-31")).select("symbol", "date", "open")


@query
def quote_latest(spark, d):
    e, k = X.table(spark, d, "events"), F.col("event_id")
    raw = e.select(F.upper("event_type").alias("symbol"), "ts", F.when(k % 3 == 0, "N/A").when(k % 5 == 0, "abc").otherwise(F.col("user_id").cast("string")).alias("last"), k.cast("string").alias("bid"), F.lit("N/A").alias("ask"), F.lit(" 7 ").alias("volume"), (k * 2).cast("string").alias("open"), F.when(k % 7 != 0, k.cast("string")).alias("70"), F.lit("").alias("71"))
    return providers.latest_quotes(raw).drop("ts")


@query
def period_codes(spark, d):
    days = X.table(spark, d, "part").select((F.col("p_size") * 20 - 15).alias("days")).distinct()
    return days.select("days", providers.period_code(F.col("days")).alias("period"))


@query
def provider_capabilities(spark, d):
    """Which provider can serve the bars of how many parts, each part wanting one interval."""
    wanted = F.element_at(F.array(*map(F.lit, S.INTERVALS)), (F.col("p_partkey") % 6 + 1).cast("int"))
    parts = X.table(spark, d, "part").groupBy(wanted.alias("interval")).agg(F.count("*").alias("n"))
    made = parts.join(F.broadcast(providers.capabilities(spark)), "interval")  # a row for each provider and interval
    return made.withColumn("bar_code", providers.bar_code(F.col("interval")))


@query
def zero_volume_runs(spark, d):
    return Q.zero_volume_runs(X.daily_bars(spark, d), 1)


@query
def price_spike(spark, d):
    return Q.price_spikes(X.daily_bars(spark, d), 2.0).select("symbol", "date", "close")


@query
def bar_spacing(spark, d):
    made = Q.spacing_errors(bars_from_ticks(X.ticks(spark, d)))
    return made.withColumn("bar_time", F.col("bar_time").cast("string"))


@query
def session_rule(spark, d):
    bars = providers.map_gateway_bars(_gateway_bars(spark, d).where("interval = '1h'"))
    return V.rule_hits(V.validate(bars, STREAMS["intraday"])).where("rule = 'bar_within_market_hours'")


@query
def indicators(spark, d):
    return Q.indicators(X.daily_bars(spark, d))


@query
def trend(spark, d):
    return Q.trend(X.daily_bars(spark, d))


@query
def rule_errors(spark, d):
    """Bars whose prices came as text, some of it no numbers: rules that can't be evaluated warn."""
    v = F.col("volume")
    bars = X.daily_bars(spark, d).withColumns({
        "low": F.when(v % 7 == 0, "n/a").otherwise(F.col("low").cast("string")),
        "vwap": F.when(v % 11 == 0, "?").otherwise(F.col("vwap").cast("string")),
    })
    found = V.validate(bars).select(F.explode("fired").alias("x")).select("x.*").where(F.startswith("message", F.lit("Rule evaluation error")))
    return found.groupBy("rule", "severity", "action").agg(F.count("*").alias("hits"))


def _commands(spark, d):
    k = F.col("instrument_id")
    name = F.element_at(F.array(*map(F.lit, O.EFFECTS)), (k % 5 + 1).cast("int"))
    return X.suppliers(spark, d).where("instrument_id % 3 = 0").select(k.alias("command_id"), "instrument_id", name.alias("command"), F.when(k % 2 == 0, "PENDING").otherwise("DONE").alias("status"), F.lit(None).cast("string").alias("consumed_at"))


@query
def command_effects(spark, d):
    return O.command_effects(X.feeds(spark, d), _commands(spark, d))


@query
def command_consume(spark, d):
    return O.consume(_commands(spark, d), O.command_effects(X.feeds(spark, d), _commands(spark, d)), F.lit("now"))


@query
def batch_scope(spark, d):
    rows = [("daily_ab", "A,B", 5, True), ("daily_c", "C", None, True), ("daily_d", "D", 3, True), ("off", "A", 1, False)]
    return O.batch_scope(X.feeds(spark, d), spark.createDataFrame(rows, "job_type string, groups string, max_symbols_per_run int, is_active boolean"))


def _log(spark, d):
    return X.table(spark, d, "orders").select(F.col("o_custkey").alias("instrument_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"), F.to_date("o_orderdate").alias("completed_at"))


@query
def last_success(spark, d):
    return O.last_success(_log(spark, d))


@query
def recent_failures(spark, d):
    return O.failed_since(_log(spark, d), _day("1998-06-30"), 7).groupBy("completed_at").agg(F.count("*").alias("n"))


@query
def table_counts(spark, d):
    return O.table_counts({n: X.table(spark, d, n) for n in ("region", "nation", "supplier", "part", "orders")})


@query
def constraint_checks(spark, d):
    return O.violations(X.listings(spark, d), not_null=("symbol", "exchange_mic"), unique=("instrument_id",))


def _job(spark, d, repaired: bool = False):
    """A run of 1999 over landed chunks, some of them broken or missing; with ``repaired`` a second one over whole ones after it."""
    bars = X.daily_bars(spark, d)
    store, k = TableStore(spark, folder(spark, "store")), F.substring("symbol", 2, 9).cast("long")
    who = bars.select("symbol").distinct().select("symbol", (k + 1).alias("instrument_id"), F.lit(None).cast("date").alias("history_start"))
    mark = who.where("symbol = 'S9'").select("instrument_id", F.lit("daily").alias("stream"), F.lit("suspended").alias("status"))
    store.replace("ingestion_watermark", S.conform(mark, S.WATERMARK_SCHEMA))
    cfg = P.PlanConfig(STREAMS["daily"], date_range=P.Override(True, (), date.fromisoformat(X.RUN_START), date.fromisoformat(X.RUN_END)))
    made = None
    for batch, whole in (("b1", False), ("b2", True))[: 2 if repaired else 1]:
        requests = run_job(store, {}, who, cfg, date(2001, 6, 18), batch, dry_run=True).requests
        root = folder(spark, "landed")
        N.land(X.chunk_lines(bars, requests, whole), root)
        made = run_job(store, {"ibkr": N.ChunkFiles(root)}, who, cfg, date(2001, 6, 18), batch, "v1")
    return store, made


@query
def run_job_report(spark, d):
    return _job(spark, d)[1].report.withColumn("error", F.substring_index("error", ":", 1))


@query
def run_job_summary(spark, d):
    return _job(spark, d)[1].summary


@query
def run_job_hits(spark, d):
    """Rules that fired in a run, as counted while its batch was written."""
    return _job(spark, d)[1].batch.hits


@query
def chunk_failures(spark, d):
    return _job(spark, d)[1].failed.select("symbol", "interval", "chunk", "chunk_start", "chunk_end", F.substring_index("error", ":", 1).alias("error"))


@query
def write_batch(spark, d):
    """What two batches leave stored: the second brings the first one's lost chunks, and corrections."""
    store, _ = _job(spark, d, repaired=True)
    return J.stored_bars(store, "market_data_daily").groupBy("symbol", "batch_id", "record_version", "is_amended").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query
def watermarks_after_run(spark, d):
    store, _ = _job(spark, d, repaired=True)
    return store.read("ingestion_watermark").select("instrument_id", "earliest_date", "latest_date", "batch_id", "mode", "status", "consecutive_failures")


@query
def silver_refresh(spark, d):
    """The latest versions after a history and a batch of corrections, brought up to date for the batch's months alone."""
    store, bars = TableStore(spark, folder(spark, "store")), X.stored_bars(X.daily_bars(spark, d))
    history = S.conform(bars, S.BARS_SCHEMA)
    store.append("bars", J.partitioned(history, 0), ("interval", "month"))
    J.refresh_silver(store, "bars", "silver", J.months_of(history))
    amended = S.conform(K.amend(_classified(spark, d), "b1"), S.BARS_SCHEMA)
    store.append("bars", J.partitioned(amended, 0), ("interval", "month"))
    J.refresh_silver(store, "bars", "silver", J.months_of(amended))
    return J.stored_bars(store, "silver").select("symbol", "date", "close", "record_version", "batch_id")


@query
def listing_as_of(spark, d):
    """Bars under the symbol that their instrument had on the day, every fifth one renamed twice."""
    sid = F.substring("symbol", 2, 9).cast("long")
    bars = X.daily_bars(spark, d).select(sid.alias("instrument_id"), "date")
    row = lambda name, a, z: bars.select("instrument_id", name.alias("symbol"), F.lit("XNYS").alias("exchange_mic"), a.alias("valid_from"), z.alias("valid_to")).distinct()
    name, k, open_ = lambda p: F.concat(F.lit(p), F.col("instrument_id").cast("string")), F.col("instrument_id"), F.lit(None).cast("date")
    plain = row(name("S"), open_, open_).where("instrument_id % 5 != 0 and instrument_id != 3")
    renamed = [row(name(p), a, z).where("instrument_id % 5 = 0") for p, a, z in (("OLD", open_, _day("1997-03-10")), ("MID", _day("1997-03-10"), _day("1997-11-03")), ("NEW", _day("1997-11-03"), open_))]
    late = row(name("S"), _day("1999-07-01"), open_).where(k == 3)
    listing = plain.unionAll(late).unionAll(renamed[0]).unionAll(renamed[1]).unionAll(renamed[2])
    return U.as_of(bars, listing).groupBy("instrument_id", "symbol").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query
def rejects_reprocessed(spark, d):
    """Rejects judged again without the rule on vwap: what passes is closed, all else stays open."""
    rejects = V.rejected_records(V.validate(X.daily_bars(spark, d)), "b1", "v1", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    judged = V.rejudged(rejects, replace(STREAMS["daily"], additional_rules=(), disabled_rules=("vwap_between_low_and_high",)))
    made = V.closed(rejects, judged, "b2", F.lit("2026-01-03 03:04:05").cast("timestamp"))
    return made.select("symbol", "date", "rejected_rule", "reprocessed", "reprocessed_at", "reprocessed_batch")


@query
def validation_compact(spark, d):
    """Batch summaries as JSON without bars; read back here, as engines write JSON differently."""
    made = V.compact(V.validate(X.daily_bars(spark, d)))
    read = F.from_json("summary", "total_input long, total_passed long, total_flagged long, total_rejected long, pass_rate_pct double, rejection_rate_pct double, rule_hits map<string,long>")
    return made.select("symbol", "interval", read.alias("s")).select("symbol", "interval", "s.total_input", "s.total_rejected", "s.pass_rate_pct", F.explode("s.rule_hits").alias("rule", "hits"))


@query
def foreign_keys(spark, d):
    """Line items with some parts, orders and quantities changed, against the keys of their tables."""
    rows = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 50 == 0, -1).otherwise(F.col("l_partkey")).alias("part"),
        F.when(F.col("l_orderkey") % 70 != 0, F.col("l_suppkey")).alias("supplier"), F.when(F.col("l_orderkey") % 90 == 0, 1).otherwise(F.col("l_linenumber")).alias("line"),
    )
    asked = G.Constraints(("supplier",), (("l_orderkey", "line"),), {"part": ("part", "p_partkey"), "supplier": ("supplier", "s_suppkey")})
    return G.broken(rows, asked, references={n: X.table(spark, d, n) for n in ("part", "supplier")}).select("l_orderkey", "l_linenumber", "constraint_name")


def _followed(spark, d):
    """A history and two batches of corrections, followed by the stream after the first and at the end."""
    store, checkpoint = TableStore(spark, folder(spark, "store")), folder(spark, "follow")
    store.append("bars", J.partitioned(S.conform(X.stored_bars(X.daily_bars(spark, d)), S.BARS_SCHEMA), 0), ("interval", "month"))
    follow(store, "bars", "silver", "changes", checkpoint).awaitTermination()
    amended = S.conform(K.amend(_classified(spark, d), "b1"), S.BARS_SCHEMA)
    store.append("bars", J.partitioned(amended, 0), ("interval", "month"))
    follow(store, "bars", "silver", "changes", checkpoint).awaitTermination()
    return store


@query
def change_feed_silver(spark, d):
    return J.stored_bars(_followed(spark, d), "silver").select("symbol", "date", "close", "record_version", "batch_id")


@query
def change_feed_counts(spark, d):
    return change_counts(_followed(spark, d), "changes")


def _in_order(lines, by):
    """Lines as one text file in this order: a seed or a fund's holdings come as one."""
    path = folder(lines.sparkSession, "file")
    lines.repartition(1).sortWithinPartitions(by).select("value").write.text(path)
    return path


@query
def provider_read_yahoo(spark, d):
    """The price download as landed, read for a range of days whose last one counts."""
    e, k = X.table(spark, d, "events"), F.col("event_id")
    raw = e.select(
        F.upper("event_type").alias("symbol"), F.lit("1h").alias("interval"), F.col("ts").cast("timestamp").alias("ts"), *[F.col("value").alias(c) for c in ("Open", "High", "Low", "Close")],
        F.col("user_id").alias("Volume"), F.when(k % 15 == 0, 0.75).alias("Dividends"), F.lit(None).cast("double").alias("Stock Splits"),
    )
    path = folder(spark, "yahoo")
    raw.write.parquet(path)
    made = providers.read_bars(spark, path, "yahoo", "2024-01-03", "2024-01-20")
    return made.groupBy("symbol", "date", "source", "has_corporate_action").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"), F.max("close").alias("close"))


@query
def etf_csv(spark, d):
    """A fund's holdings as a CSV file with lines above its header."""
    k = F.col("p_partkey")
    value = F.concat(F.when(k % 100 == 0, "-").otherwise(F.concat(F.lit(" p"), k.cast("string"))), F.lit(',"'), F.col("p_name"), F.lit(', Inc",'), F.when(k % 7 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("%"))))
    above = spark.createDataFrame([(-3, "Fund Holdings"), (-2, "as of,today"), (-1, "Ticker,Name,Weight")], "n long, value string")
    path = _in_order(above.unionByName(X.table(spark, d, "part").select(k.alias("n"), value.alias("value"))), "n")
    cfg = etf.EtfFile("SPY", "SP500", 0, skip_rows=2)
    return etf.merge(etf.union_of([(cfg, etf.parse_csv(spark, path, cfg))])).select("symbol", F.array_join("universe_codes", ",").alias("universe_codes"), "weight", "company_name", "is_active")


@query
def ticker_seed(spark, d):
    k = F.col("instrument_id")
    row = F.concat_ws(",", F.concat(F.lit(" s"), k.cast("string")), F.col("s_name"), F.lit("Tech"), F.lit("equity"), F.when(k % 3 == 0, "no").when(k % 3 == 1, "Yes").otherwise(""),
                      F.when(k % 4 == 0, "2020-13-01").otherwise("2020-02-03"), F.when(k % 5 == 0, "x").otherwise("1.5"), F.lit("large"), F.lit(""), F.lit("1999-1-1"), F.lit(" n "))
    head = spark.createDataFrame([(-1, ",".join(S.TICKER_SCHEMA.names))], "n long, value string")
    path = _in_order(head.unionByName(X.suppliers(spark, d).select(k.alias("n"), row.alias("value"))), "n")
    return files.read_tickers(spark, path).select("symbol", "name", "active", "added_date", "min_price", "history_start", "ipo_date", "notes")


@query
def strategy_seed(spark, d):
    head = spark.createDataFrame([(-1, "strategy,entry_indicators")], "n long, value string")
    rows = X.table(spark, d, "nation").select(F.col("n_nationkey").alias("n"), F.concat(F.col("n_name"), F.lit(',"rsi, ema'), F.col("n_regionkey").cast("string"), F.lit(' ,macd"')).alias("value"))
    made = files.read_strategies(spark, _in_order(head.unionByName(rows), "n"))
    return made.select("strategy", F.array_join("entry_indicators", "|").alias("entry_indicators"))


@query
def raw_landing(spark, d):
    """A directory file kept as it came, and parsed from there."""
    path = files.land_text(X.nasdaq_lines(spark, d), folder(spark, "raw"), "nasdaq", "2026-01-02")
    return listings.parse_nasdaq(spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())).drop("line_no")


@query
def threshold_override(spark, d):
    """A stream's own limits on moves and gaps."""
    own = replace(STREAMS["daily"], thresholds={"price_change_pct_threshold": 20.0, "gap_threshold": 5.0}, additional_rules=())
    return V.rule_hits(V.validate(X.daily_bars(spark, d), own))


@query
def trade_count_rule(spark, d):
    own = replace(STREAMS["daily"], additional_rules=(("trade_count_positive", "warning", "flag_record"),))
    v = F.col("volume")
    return V.rule_hits(V.validate(X.daily_bars(spark, d).withColumn("trade_count", F.when(v % 9 == 7, 0).when(v % 9 == 8, -1).when(v % 9 != 6, F.col("trade_count"))), own))


@query
def seed_if_empty(spark, d):
    """What a table holds after it was created, seeded, and seeded again with something else."""
    store, rows = TableStore(spark, folder(spark, "store")), S.conform(X.instruments(spark, d), S.INSTRUMENT_SCHEMA)
    made = [store.create("instrument", S.INSTRUMENT_SCHEMA), store.seed("instrument", rows), store.seed("instrument", rows.limit(1)), store.create("instrument", S.INSTRUMENT_SCHEMA)]
    told = F.lit(",".join(str(m).lower() for m in made))
    return store.read("instrument").select("instrument_id", "asset_class", "figi", told.alias("made"))


@query
def append_batches(spark, d):
    """Feeds appended group by group to a table in partitions."""
    store, rows = TableStore(spark, folder(spark, "store")), X.feeds(spark, d)
    for group in "ABCD":
        store.append("feeds", rows.where(F.col("batch_group") == group), ("batch_group",))
    return store.read("feeds").groupBy("batch_group", "is_active").agg(F.count("*").alias("n"), F.sum("instrument_id").alias("ids"))


@query
def new_preview(spark, d):
    """How many symbols are new, and the first five of them."""
    new = U.new_symbols(_incoming_symbols(spark, d), X.listings(spark, d))
    total = new.agg(F.count("*").alias("n_new"))
    return U.preview(new).select("symbol", F.lit(total.first().n_new).alias("n_new"))
