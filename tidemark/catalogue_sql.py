"""SQL that gives each query's rows from the test tables."""

from __future__ import annotations

from tidemark.functions.calendar import holidays

BARS = """
px AS (SELECT l_suppkey % 20 AS sid, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber, 100 + l_extendedprice / 1000 AS price, l_quantity AS qty, l_extendedprice AS ep FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY sid, d ORDER BY l_orderkey, l_linenumber, ep, qty) AS ra, row_number() OVER (PARTITION BY sid, d ORDER BY l_orderkey DESC, l_linenumber DESC, ep DESC, qty DESC) AS rz FROM px),
b AS (SELECT sid, d, max(CASE WHEN ra = 1 THEN price END) AS open, max(price) AS high, min(price) AS low, max(CASE WHEN rz = 1 THEN price END) AS close, CAST(sum(qty) AS BIGINT) AS volume,
  100 + CAST(sum(CAST(ep AS DECIMAL(18,2)) * CAST(qty AS DECIMAL(4,0))) AS DOUBLE) / sum(qty) / 1000 AS vwap, CAST(count(*) AS BIGINT) AS trade_count, sid * 31 + (d - DATE '1995-01-01') AS k FROM o GROUP BY sid, d),
bars AS (SELECT concat('S', CAST(sid AS VARCHAR)) AS symbol, d AS date, '1d' AS interval, 'synthetic' AS source, open, CASE WHEN k % 97 = 0 THEN low - 1 ELSE high END AS high, low,
  CASE WHEN k % 83 = 0 THEN NULL ELSE close END AS close, CASE WHEN k % 89 = 0 THEN 0 ELSE volume END AS volume, CASE WHEN k % 79 = 0 THEN high * 2 ELSE vwap END AS vwap, trade_count,
  lag(close) OVER (PARTITION BY sid ORDER BY d) AS prev_close FROM b)"""

# (rule, severity, condition), in order
_RULES = [
    ("high_gte_low", "critical", "high < low - 1e-9"),
    ("high_gte_open", "critical", "high < open - 1e-9"),
    ("high_gte_close", "critical", "high < close - 1e-9"),
    ("low_lte_open", "critical", "low > open + 1e-9"),
    ("low_lte_close", "critical", "low > close + 1e-9"),
    ("no_null_ohlcv", "critical", "open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL"),
    ("price_positive", "critical", "open <= 0 OR high <= 0 OR low <= 0 OR close <= 0"),
    ("prev_close_positive", "critical", "prev_close <= 0"),
    ("volume_positive", "warning", "volume <= 0"),
    ("vwap_between_low_and_high", "critical", "vwap < low - 1e-9 OR vwap > high + 1e-9"),
    ("price_change_pct_threshold", "warning", "prev_close > 0 AND abs((close - prev_close) / prev_close) * 100 > 50"),
    ("gap_threshold", "warning", "prev_close > 0 AND abs((open - prev_close) / prev_close) * 100 > 15"),
]
_CRITICAL = "[" + ", ".join(f"'{n}'" for n, s, _ in _RULES if s == "critical") + "]"
_FIRED = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, _, c in _RULES) + "], lambda x: x IS NOT NULL)"


def _checked(source: str = "bars") -> str:
    return f"""
f AS (SELECT *, {_FIRED} AS fired FROM {source}),
checked AS (SELECT *, list_filter(fired, lambda x: list_contains({_CRITICAL}, x)) AS crit, CASE WHEN list_has_any(fired, {_CRITICAL}) THEN 'rejected' WHEN len(fired) > 0 THEN 'flagged' ELSE 'clean' END AS outcome FROM f)"""


CHECKED = f"{BARS},{_checked()}"
HOLIDAYS = "holidays(date) AS (VALUES " + ", ".join(f"(DATE '{d}')" for d in holidays()) + ")"


def _days(a: str, z: str) -> str:
    return f"days AS (SELECT CAST(unnest(generate_series(DATE '{a}', DATE '{z}', INTERVAL 1 DAY)) AS DATE) AS date), {HOLIDAYS}, trading AS (SELECT date FROM days WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM holidays))"


ORDER_DAYS = "order_days AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) + INTERVAL 28 YEAR AS DATE) AS date FROM orders)"
SUP = "sup AS (SELECT s_suppkey AS instrument_id, 'S' || s_suppkey AS symbol, s_nationkey FROM supplier)"
INSTRUMENT = "instrument AS (SELECT instrument_id, CASE WHEN instrument_id % 5 = 0 THEN 'etf' ELSE 'equity' END AS asset_class, CASE WHEN instrument_id % 4 <> 0 THEN 'FIGI' || instrument_id END AS figi FROM sup)"
LISTING = """listing AS (SELECT instrument_id, symbol, CASE n_regionkey WHEN 0 THEN 'XNAS' WHEN 1 THEN 'XNYS' WHEN 2 THEN 'ARCX' WHEN 3 THEN 'XASE' END AS exchange_mic, TRUE AS is_current FROM sup JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT instrument_id, 'OLD' || instrument_id, 'XNYS', FALSE FROM sup WHERE instrument_id % 10 = 0)"""
MEMBERSHIP = "membership AS (SELECT instrument_id, 'SP500' AS universe_code FROM sup WHERE instrument_id % 2 = 0 UNION ALL SELECT instrument_id, 'NDX100' FROM sup WHERE instrument_id % 3 = 0)"
FEED = "feed AS (SELECT instrument_id, instrument_id % 7 <> 0 AS is_active, substr('ABCD', CAST(instrument_id % 4 + 1 AS INT), 1) AS batch_group, CAST(instrument_id % 5 AS INT) AS priority FROM sup)"
UNIVERSE = ", ".join((SUP, INSTRUMENT, LISTING, MEMBERSHIP, FEED))
STORED = "stored AS (SELECT * FROM bars WHERE date < DATE '2001-01-01'), incoming AS (SELECT * REPLACE (CASE WHEN volume % 10 = 0 THEN close + 0.5 ELSE close END AS close) FROM bars WHERE date >= DATE '2000-12-01')"


def _classified(source: str = "incoming") -> str:
    differs = " OR ".join(f"coalesce(abs(i.{c} - s.{c}) > 0.001, FALSE)" for c in ("open", "high", "low", "close", "volume"))
    return f"classified AS (SELECT i.*, CASE WHEN s.symbol IS NULL THEN 'new' WHEN {differs} THEN 'amend' ELSE 'skip' END AS action FROM {source} i LEFT JOIN stored s ON i.symbol = s.symbol AND i.date = s.date AND i.interval = s.interval)"


HISTORY = f"{BARS}, {STORED}"
MARKS = "marks AS (SELECT CAST(substr(symbol, 2) AS BIGINT) AS instrument_id, min(date) AS earliest_date, max(date) AS latest_date, count(*) AS record_count FROM stored GROUP BY 1)"
HOURLY = """
t AS (SELECT upper(event_type) AS symbol, date_trunc('hour', ts) AS bar, ts, value FROM events),
hourly AS (SELECT symbol, bar, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS volume FROM t GROUP BY symbol, bar)"""
LINES = """
l AS (SELECT p_partkey AS k, 'P' || p_partkey || CASE WHEN p_partkey % 50 = 0 THEN '$' ELSE '' END AS symbol, p_name || CASE WHEN p_partkey % 11 = 0 THEN ' Warrant' WHEN p_partkey % 13 = 0 THEN ' Units' ELSE '' END AS name,
  CASE WHEN p_size > 40 THEN 'etf' ELSE 'equity' END AS asset_class FROM part),
ok AS (SELECT * FROM l WHERE k % 17 <> 0 AND k % 50 <> 0 AND NOT regexp_matches(lower(name), ' warrant| right| unit| preferred| pfd| note| bond| debenture|test| acquisition| spac'))"""
_CODE = "substr('ANPZVX', CAST(k % 6 + 1 AS INT), 1)"
_MIC = "CASE k % 6 WHEN 0 THEN 'XASE' WHEN 1 THEN 'XNYS' WHEN 2 THEN 'ARCX' WHEN 3 THEN 'BATS' WHEN 4 THEN 'IEXG' END"
HOLDINGS = """
h0 AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 100 = 0 THEN 'CASH' ELSE 'P' || p_partkey END AS symbol, p_name AS company_name, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) / 100 END AS weight FROM part),
h AS (SELECT *, 0 AS o, 'SP500' AS code FROM h0 WHERE k % 2 = 0 UNION ALL SELECT *, 1, 'NDX100' FROM h0 WHERE k % 3 = 0 UNION ALL SELECT *, 2, 'R2K' FROM h0 WHERE k % 5 = 0),
etfs AS (SELECT symbol, string_agg(code, ',' ORDER BY o) AS universe_codes, any_value(weight) AS weight, any_value(company_name) AS company_name, bool_or(code IN ('SP500', 'NDX100')) AS is_active FROM h WHERE symbol <> 'CASH' GROUP BY symbol)"""
INCOMING_SYMBOLS = "inc AS (SELECT symbol FROM sup UNION ALL SELECT 'X' || instrument_id FROM sup WHERE instrument_id % 4 = 0)"
PLANS = f"""
{HISTORY}, {SUP}, {MARKS},
w AS (SELECT s.instrument_id AS k, symbol, CASE WHEN s.instrument_id % 3 = 0 THEN DATE '1999-05-01' END AS history, earliest_date AS earliest,
  latest_date + CAST((s.instrument_id % 4) * 55 + CASE WHEN s.instrument_id % 5 = 0 THEN 120 ELSE 0 END AS INT) AS latest, CASE WHEN s.instrument_id % 6 >= 3 THEN 'suspended' ELSE 'active' END AS status
  FROM sup s LEFT JOIN marks m ON s.instrument_id = m.instrument_id),
m1 AS (SELECT *, DATE '2001-06-18' AS today, coalesce(history, DATE '1991-06-18') AS initial,
  CASE WHEN latest IS NOT NULL AND status = 'suspended' THEN 'NO_OP' WHEN symbol IN ('S1', 'S30') THEN 'FORCE_RELOAD' WHEN symbol IN ('S2', 'S7') THEN 'RESTATEMENT' WHEN symbol IN ('S2', 'S6') THEN 'EXPLICIT_DATE_RANGE'
    WHEN symbol IN ('S8', 'S40') AND DATE '1994-01-01' < earliest THEN 'HISTORY_EXTENSION' WHEN latest IS NULL THEN 'INITIAL_LOAD' WHEN DATE '2001-06-18' - latest > 30 THEN 'GAP_FILL' WHEN latest >= DATE '2001-06-18' THEN 'NO_OP' ELSE 'INCREMENTAL' END AS mode FROM w),
m2 AS (SELECT symbol, mode,
  CAST(CASE mode WHEN 'NO_OP' THEN today WHEN 'FORCE_RELOAD' THEN initial WHEN 'RESTATEMENT' THEN DATE '2000-01-03' WHEN 'EXPLICIT_DATE_RANGE' THEN DATE '1999-06-01' WHEN 'HISTORY_EXTENSION' THEN DATE '1994-01-01' WHEN 'INITIAL_LOAD' THEN initial WHEN 'GAP_FILL' THEN latest + 1 ELSE greatest(latest - 3, earliest) END AS DATE) AS start_date,
  CAST(CASE mode WHEN 'RESTATEMENT' THEN DATE '2000-03-03' WHEN 'EXPLICIT_DATE_RANGE' THEN DATE '1999-06-30' WHEN 'HISTORY_EXTENSION' THEN earliest - 1 ELSE today END AS DATE) AS end_date FROM m1),
plans AS (SELECT *, CASE mode WHEN 'RESTATEMENT' THEN 'amendment' WHEN 'NO_OP' THEN 'scheduled' WHEN 'INCREMENTAL' THEN 'scheduled' ELSE 'backfill' END AS ingestion_type, mode = 'RESTATEMENT' AS is_amendment_run, end_date - start_date + 1 AS date_range_days FROM m2)"""
MARKED = f"""
{HISTORY}, {MARKS},
u0 AS (SELECT CAST(substr(symbol, 2) AS BIGINT) AS s, date FROM incoming),
u AS (SELECT CASE WHEN s < 5 THEN s + 100 ELSE s END AS instrument_id, min(date) AS e, max(date) AS l, count(*) AS n FROM u0 GROUP BY 1 HAVING CASE WHEN s < 5 THEN s + 100 ELSE s END > 7),
j AS (SELECT coalesce(u.instrument_id, m.instrument_id) AS instrument_id, u.instrument_id IS NOT NULL AS hit, m.instrument_id IS NOT NULL AS had, e, l, n, earliest_date, latest_date, record_count, u.instrument_id % 4 = 0 AS failed, CAST(m.instrument_id % 6 AS INT) AS old_failures FROM u FULL JOIN marks m ON u.instrument_id = m.instrument_id),
after AS (SELECT instrument_id, 'daily' AS stream, least(e, earliest_date) AS earliest_date, greatest(l, latest_date) AS latest_date, CASE WHEN hit THEN n ELSE record_count END AS record_count, CASE WHEN hit THEN 'b1' ELSE 'b0' END AS batch_id, CASE WHEN hit THEN 'INCREMENTAL' ELSE 'INITIAL_LOAD' END AS mode,
  CAST(CASE WHEN NOT hit THEN old_failures WHEN failed THEN coalesce(old_failures, 0) + 1 ELSE 0 END AS INT) AS consecutive_failures, CASE WHEN had THEN 't0' ELSE 't1' END AS created_at, CASE WHEN hit THEN 't1' ELSE 't0' END AS updated_at FROM j)"""
TICKERS = """tickers AS (SELECT symbol, CASE WHEN instrument_id % 5 = 0 THEN 'etf' ELSE 'equity' END AS asset_class, CASE WHEN instrument_id % 2 = 0 THEN 'Tech' ELSE 'Health' END AS sector, instrument_id % 6 <> 0 AS active,
  CASE WHEN instrument_id % 3 = 0 THEN DATE '1990-01-01' + CAST(instrument_id AS INT) END AS history_start, DATE '1980-01-01' + CAST(instrument_id AS INT) AS ipo_date FROM sup)"""
COMMANDS = "commands AS (SELECT instrument_id AS command_id, instrument_id, ['FORCE_RELOAD', 'HISTORY_LOAD', 'PAUSE', 'RESUME', 'SKIP_ONCE'][CAST(instrument_id % 5 + 1 AS INT)] AS command, CASE WHEN instrument_id % 2 = 0 THEN 'PENDING' ELSE 'DONE' END AS status FROM sup WHERE instrument_id % 3 = 0)"
GATEWAY = """
g AS (SELECT upper(event_type) AS symbol, event_id AS k, CASE event_id % 3 WHEN 0 THEN '1d' WHEN 1 THEN '1h' ELSE '5m' END AS interval, epoch_us(ts) // 1000 AS ms, value, user_id FROM events WHERE event_id % 50 <> 0 AND event_id % 60 <> 0 AND value > 0),
gt AS (SELECT *, make_timestamp(ms * 1000) AS utc FROM g)"""
_LOCAL = "timezone('America/New_York', timezone('UTC', {}))"
_RUN = f"{BARS}, {STORED}, {_checked('incoming')}, wr AS (SELECT * FROM checked WHERE outcome <> 'rejected'), {_classified('wr')}"
_PRESENT = lambda names: " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n in names)
_FULL = f"round_even(({_PRESENT(('open', 'high', 'low', 'close', 'volume', 'prev_close', 'vwap'))}) / 8 * 80.0 + (CAST(trade_count IS NOT NULL AS INT)) / 5 * 20.0, 1)"
_LAST = "OVER (PARTITION BY symbol, interval ORDER BY date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
_SEQ = "OVER (PARTITION BY symbol, interval ORDER BY date)"


def _over(n: int) -> str:
    return _LAST.format(n - 1)


ORACLE_SQL: dict[str, str] = {
    "bars_daily": f"WITH {BARS} SELECT * FROM bars",
    "bars_intraday_1h": f"WITH {HOURLY} SELECT symbol, strftime(bar, '%Y-%m-%d %H:%M:%S') AS bar_time, '1h' AS interval, open, high, low, close, volume FROM hourly",
    "bar_metrics": f"""WITH {BARS}, p AS (SELECT *, lag(close) {_SEQ} AS prev FROM bars WHERE close IS NOT NULL), m AS (SELECT symbol, date, high - low AS price_range, CASE WHEN prev > 0 THEN (close - prev) / prev * 100 END AS daily_return_pct, CASE WHEN prev > 0 THEN (open - prev) / prev * 100 END AS gap_pct FROM p)
        SELECT *, gap_pct > 0.5 AS is_gap_up, gap_pct < -0.5 AS is_gap_down FROM m""",
    "rule_hits": f"WITH {CHECKED}, x AS (SELECT unnest(fired) AS rule FROM checked) SELECT rule, CASE WHEN list_contains({_CRITICAL}, rule) THEN 'critical' ELSE 'warning' END AS severity, count(*) AS hits FROM x GROUP BY rule",
    "rule_hits_defects": f"""WITH {BARS}, bad AS (SELECT * REPLACE (CASE volume % 9 WHEN 0 THEN open + 0.25 WHEN 1 THEN close + 0.25 WHEN 2 THEN -1.0 ELSE low END AS low, CASE WHEN volume % 9 = 3 THEN 0.0 ELSE prev_close END AS prev_close) FROM bars),
        x AS (SELECT unnest([CASE WHEN low > open + 1e-9 THEN 'low_lte_open' END, CASE WHEN low > close + 1e-9 THEN 'low_lte_close' END, CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'price_positive' END, CASE WHEN prev_close <= 0 THEN 'prev_close_positive' END,
          CASE WHEN volume % 9 = 4 THEN 'pre_market_volume_non_negative' END, CASE WHEN volume % 9 = 5 THEN 'amended_record_detected' END, CASE WHEN volume % 9 = 6 THEN 'fetch_duration_threshold' END]) AS rule FROM bad)
        SELECT rule, CASE WHEN rule IN ('amended_record_detected', 'fetch_duration_threshold') THEN 'warning' ELSE 'critical' END AS severity, count(*) AS hits FROM x WHERE rule IS NOT NULL GROUP BY rule""",
    "plan_override": f"WITH {PLANS} SELECT symbol, 'EXPLICIT_DATE_RANGE' AS mode, DATE '2000-02-01' AS start_date, DATE '2000-04-30' AS end_date, 'backfill' AS ingestion_type, TRUE AS is_backfill, FALSE AS is_amendment_run, 90 AS date_range_days, 3 AS estimated_batches FROM plans",
    "order_alerts": f"""WITH {HOURLY}, {BARS}, days AS (SELECT symbol, date - lag(date) OVER (PARTITION BY symbol ORDER BY date) - 2 AS missing FROM bars), v AS (SELECT symbol, bar, close, CASE WHEN volume % 3 = 0 THEN 0 ELSE volume END AS volume FROM hourly),
        s AS (SELECT symbol, 'consistent_bar_spacing' AS rule FROM (SELECT symbol, bar, lag(bar) OVER (PARTITION BY symbol ORDER BY bar) AS p FROM v) WHERE p IS NOT NULL AND date_diff('minute', p, bar) <> 60),
        i AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar) - row_number() OVER (PARTITION BY symbol, volume <= 0 ORDER BY bar) AS island FROM v),
        z AS (SELECT symbol, 'consecutive_zero_volume' AS rule FROM i WHERE volume <= 0 GROUP BY symbol, island HAVING count(*) >= 3),
        c AS (SELECT symbol, bar, CAST(round(close * 100) AS BIGINT) AS x FROM v),
        w AS (SELECT symbol, x, count(x) OVER o AS n, CAST(sum(x) OVER o AS DOUBLE) AS s, CAST(sum(CAST(x * x AS HUGEINT)) OVER o AS DOUBLE) AS q FROM c WINDOW o AS (PARTITION BY symbol ORDER BY bar ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
        ps AS (SELECT symbol, 'tick_price_spike' AS rule FROM w WHERE n = 20 AND pow(x * 20.0::DOUBLE - s, 2) > 9 * (q * 20 - pow(s, 2)))
        SELECT symbol, rule, count(*) AS n FROM (SELECT * FROM s UNION ALL SELECT * FROM z UNION ALL SELECT * FROM ps UNION ALL SELECT DISTINCT symbol, 'max_consecutive_missing_days' FROM days WHERE missing > 2) GROUP BY symbol, rule""",
    "validation_outcome": f"WITH {CHECKED} SELECT symbol, date, outcome, crit[1] AS deciding_rule FROM checked",
    "validation_summary": f"""WITH {CHECKED} SELECT symbol, interval, count(*) AS total_input, count(*) FILTER (outcome = 'clean') AS total_passed, count(*) FILTER (outcome = 'flagged') AS total_flagged, count(*) FILTER (outcome = 'rejected') AS total_rejected,
        round_even(count(*) FILTER (outcome = 'clean') / count(*) * 100, 1) AS pass_rate_pct, round_even(count(*) FILTER (outcome = 'rejected') / count(*) * 100, 1) AS rejection_rate_pct FROM checked GROUP BY symbol, interval""",
    "writable_bars": f"WITH {CHECKED} SELECT symbol, outcome, count(*) AS n FROM checked WHERE outcome <> 'rejected' GROUP BY symbol, outcome",
    "rejected_records": f"WITH {CHECKED} SELECT symbol, CAST(date AS VARCHAR) AS date, interval, source, 'b1' AS batch_id, crit[1] AS rejected_rule, '2026-01-02T03:04:05Z' AS rejected_at, TRUE AS has_reason, vwap AS raw_vwap, trade_count AS raw_trade_count, open AS raw_open, high AS raw_high, low AS raw_low, close AS raw_close, volume AS raw_volume, FALSE AS reprocessed, 'v1' AS pipeline_version FROM checked WHERE outcome = 'rejected'",
    "flagged_reasons": f"WITH {CHECKED} SELECT symbol, date, '[' || array_to_string(list_transform(fired, lambda x: '\"' || x || '\"'), ',') || ']' AS data_quality_reasons FROM checked WHERE outcome = 'flagged'",
    "audit_log": f"WITH {CHECKED}, x AS (SELECT symbol, date, interval, outcome, unnest(CASE WHEN outcome = 'flagged' THEN fired ELSE crit END) AS rule FROM checked) SELECT symbol, date, interval, rule, CASE WHEN list_contains({_CRITICAL}, rule) THEN 'critical' ELSE 'warning' END AS severity, outcome FROM x",
    "enriched_bars": f"WITH {CHECKED} SELECT symbol, date, 'b1' AS batch_id, 'scheduled' AS ingestion_type, '2026-01-02T03:04:05Z' AS ingested_at, 1 AS record_version, FALSE AS is_amended, 'USD' AS currency, close AS unadj_close, FALSE AS has_corporate_action, outcome = 'flagged' AS data_quality_flag, {_FULL} AS data_completeness_pct FROM checked WHERE outcome <> 'rejected'",
    "completeness": f"WITH {BARS} SELECT symbol, date, {_FULL} AS pct, round_even(({_PRESENT(('open', 'high', 'low', 'close', 'volume', 'prev_close'))}) / 7 * 80.0 + 0 / 2 * 20.0, 1) AS pct_yahoo FROM bars",
    "continuity_alerts": f"WITH {BARS}, g AS (SELECT symbol, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS gap_start, date AS gap_end FROM bars), m AS (SELECT *, gap_end - gap_start - 2 AS missing_days, row_number() OVER (PARTITION BY symbol ORDER BY gap_end - gap_start DESC, gap_start) AS n FROM g WHERE gap_end - gap_start > 3) SELECT symbol, gap_start, gap_end, CAST(missing_days AS INT) AS missing_days FROM m WHERE n = 1 AND missing_days > 2",
    "weekend_rule": f"WITH {BARS} SELECT 'no_weekend_dates' AS rule, 'critical' AS severity, count(*) AS hits FROM bars WHERE isodow(date) > 5 HAVING count(*) > 0",
    "corp_action_consistency": f"""WITH {BARS}, c AS (SELECT *, volume % 7 = 0 AS xs, CASE WHEN volume % 14 = 0 THEN 0.25 END AS sf, volume % 3 = 0 AS xd, CASE WHEN volume % 5 = 0 THEN 0.5 ELSE 0.0 END AS da, volume % 11 = 0 AS ca FROM bars)
        SELECT symbol, date, (xs AND sf IS NULL) OR (xd AND da <= 0) OR (ca AND sf IS NULL AND da <= 0) AS inconsistent, sf IS NOT NULL OR da > 0 AS derived_action FROM c""",
    "record_invariants": f"WITH {BARS}, x AS (SELECT unnest(list_filter([CASE WHEN volume % 10 = 0 THEN 'blank_pipeline_version' END, CASE WHEN volume % 9 = 0 THEN 'missing_bar_time' END, CASE WHEN close IS NULL THEN 'not_numeric_close' END], lambda x: x IS NOT NULL)) AS broken FROM bars) SELECT broken, count(*) AS n FROM x GROUP BY broken",
    "trading_days": f"WITH {HOLIDAYS}, {ORDER_DAYS} SELECT date FROM order_days WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM holidays)",
    "trading_day_counts": f"WITH {_days('2015-01-01', '2035-12-31')}, o AS (SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 28 YEAR AS DATE) AS a, CAST(CAST(max(o_orderdate) AS DATE) + INTERVAL 28 YEAR AS DATE) AS z FROM orders GROUP BY 1) SELECT o_custkey, a, z, count(trading.date) AS n FROM o LEFT JOIN trading ON trading.date BETWEEN a AND z GROUP BY ALL",
    "last_trading_day": f"WITH {_days('2015-01-01', '2035-12-31')}, {ORDER_DAYS} SELECT d.date, (SELECT max(t.date) FROM trading t WHERE t.date <= d.date) AS last_trading_day FROM order_days d",
    "missing_trading_days": f"""WITH {BARS}, {_days('2015-01-01', '2021-12-31')}, sh AS (SELECT symbol, CAST(date + INTERVAL 20 YEAR AS DATE) AS date FROM bars), sp AS (SELECT symbol, min(date) AS a, max(date) AS z FROM sh GROUP BY symbol)
        SELECT sp.symbol, t.date FROM sp JOIN trading t ON t.date BETWEEN a AND z WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.symbol = sp.symbol AND sh.date = t.date)""",
    "market_hours": f"WITH e AS (SELECT event_type, {_LOCAL.format('ts')} AS local FROM events) SELECT event_type, count(*) FILTER (isodow(local) < 6 AND strftime(local, '%H:%M') BETWEEN '09:30' AND '15:59') AS n_open, count(*) AS n FROM e GROUP BY event_type",
    "classify_batch": f"WITH {HISTORY}, {_classified()} SELECT symbol, date, action FROM classified",
    "amend_records": f"WITH {HISTORY}, {_classified()} SELECT symbol, date, close, 2 AS record_version, 'b0' AS supersedes_batch, 'b1' AS batch_id, TRUE AS is_amended, 'provider_correction' AS amendment_reason FROM classified WHERE action = 'amend'",
    "amend_fields": f"WITH {HISTORY} SELECT symbol, date, volume + 1 AS volume, 0.5::DOUBLE AS split_factor, 2 AS record_version, 'b0' AS supersedes_batch, 'split_adjustment' AS amendment_reason, TRUE AS has_corporate_action FROM stored WHERE volume % 100 = 0",
    "silver_latest": f"WITH {HISTORY}, {_classified()}, a AS (SELECT symbol, date, close, 1 AS record_version, 'b0' AS batch_id FROM stored UNION ALL SELECT symbol, date, close, 2, 'b1' FROM classified WHERE action = 'amend'), r AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY record_version DESC) AS n FROM a) SELECT symbol, date, close, record_version, batch_id FROM r WHERE n = 1",
    "record_counts": f"WITH {BARS} SELECT symbol, interval, count(*) AS record_count FROM bars GROUP BY symbol, interval",
    "source_fallback": f"WITH {BARS} SELECT symbol, date, CASE WHEN volume % 3 <> 0 THEN source ELSE 'fallback' END AS source, close FROM bars",
    "plan_modes": f"WITH {PLANS} SELECT symbol, mode, start_date, end_date, ingestion_type, ingestion_type = 'backfill' AS is_backfill, is_amendment_run, CAST(date_range_days AS INT) AS date_range_days, CAST(greatest(1, date_range_days // 30) AS INT) AS estimated_batches FROM plans",
    "plan_chunks": f"WITH {PLANS}, c AS (SELECT symbol, mode, start_date, end_date, unnest(generate_series(0, (end_date - start_date) // 30)) AS chunk FROM plans WHERE mode <> 'NO_OP' AND start_date <= end_date) SELECT symbol, mode, CAST(chunk AS INT) AS chunk, start_date + CAST(chunk * 30 AS INT) AS chunk_start, least(start_date + CAST(chunk * 30 + 29 AS INT), end_date) AS chunk_end FROM c",
    "watermark_upsert": f"WITH {MARKED} SELECT *, CASE WHEN consecutive_failures >= 3 THEN 'suspended' ELSE 'active' END AS status FROM after",
    "watermark_failures": f"WITH {MARKED} SELECT CASE WHEN consecutive_failures >= 3 THEN 'suspended' ELSE 'active' END AS status, count(*) AS n, CAST(sum(consecutive_failures) AS BIGINT) AS failures FROM after GROUP BY 1",
    "watermark_by_symbol": f"""WITH {HISTORY}, o1 AS (SELECT symbol, interval, min(date) AS e, max(date) AS l, count(*) AS n FROM stored GROUP BY ALL), u1 AS (SELECT symbol, interval, min(date) AS e, max(date) AS l, count(*) AS n FROM incoming WHERE symbol <> 'S3' GROUP BY ALL)
        SELECT coalesce(u1.symbol, o1.symbol) AS symbol, coalesce(u1.interval, o1.interval) AS interval, least(o1.e, u1.e) AS earliest_date, greatest(o1.l, u1.l) AS latest_date, coalesce(u1.n, o1.n) AS record_count, CASE WHEN u1.symbol IS NOT NULL THEN 'b1' ELSE 'b0' END AS batch_id, CASE WHEN u1.symbol IS NOT NULL THEN 'INCREMENTAL' ELSE 'INITIAL_LOAD' END AS mode FROM o1 FULL JOIN u1 ON o1.symbol = u1.symbol AND o1.interval = u1.interval""",
    "universe_active": f"WITH {UNIVERSE} SELECT instrument_id, symbol, asset_class, exchange_mic, batch_group, priority FROM feed JOIN listing USING (instrument_id) JOIN instrument USING (instrument_id) WHERE is_active AND is_current ORDER BY priority, symbol",
    "universe_filtered": f"WITH {UNIVERSE} SELECT instrument_id, symbol, asset_class FROM feed JOIN listing USING (instrument_id) JOIN instrument USING (instrument_id) WHERE is_active AND is_current AND symbol IN ('S1', 'S5', 'S10', 'S15') AND asset_class = 'etf'",
    "universe_lookup": f"WITH {SUP}, {TICKERS} SELECT symbol, coalesce(history_start, ipo_date) AS effective_history_start FROM tickers WHERE symbol IN ('S7', 'S9')",
    "ticker_filter": f"WITH {SUP}, {TICKERS} SELECT symbol, sector, asset_class FROM tickers WHERE active AND sector = 'Tech' AND asset_class = 'equity'",
    "ticker_counts": f"WITH {SUP}, {TICKERS} SELECT count(*) FILTER (active) AS n_active, count(*) AS n_total, count(*) FILTER (active) AS n_symbols FROM tickers",
    "listing_parse_nasdaq": f"WITH {LINES} SELECT symbol, name AS company_name, asset_class, 'NASDAQ' AS exchange, 'XNAS' AS exchange_mic, 'USD' AS currency FROM ok",
    "listing_parse_other": f"WITH {LINES} SELECT symbol, name AS company_name, asset_class, {_CODE} AS exchange, {_MIC} AS exchange_mic, 'USD' AS currency FROM ok",
    "listing_merge": f"""WITH {LINES}, a AS (SELECT 'P' || (k // 2) AS symbol, name AS company_name, 'NASDAQ' AS exchange, 'XNAS' AS exchange_mic, asset_class, 0 AS source_rank, -k AS o FROM ok
        UNION ALL SELECT 'P' || (k // 2 + 300), name, {_CODE}, {_MIC}, asset_class, 1, k FROM ok), r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY source_rank, o) AS n FROM a) SELECT symbol, company_name, exchange, exchange_mic, asset_class, source_rank FROM r WHERE n = 1""",
    "etf_merge": f"WITH {HOLDINGS} SELECT * FROM etfs",
    "symbol_overlay": f"WITH {LINES}, {HOLDINGS} SELECT coalesce(e.symbol, ok.symbol) AS symbol, CASE WHEN e.symbol IS NOT NULL THEN 'overlaid' ELSE name END AS company_name, CASE WHEN ok.symbol IS NOT NULL THEN 'XNAS' END AS exchange_mic, weight FROM ok FULL JOIN etfs e ON ok.symbol = e.symbol",
    "universe_new": f"WITH {UNIVERSE}, {INCOMING_SYMBOLS} SELECT symbol FROM inc WHERE symbol NOT IN (SELECT symbol FROM listing WHERE is_current)",
    "universe_to_enrich": f"""WITH {UNIVERSE}, {INCOMING_SYMBOLS}, cur AS (SELECT symbol, figi, instrument_id FROM listing JOIN instrument USING (instrument_id) WHERE is_current)
        SELECT symbol FROM inc WHERE (symbol LIKE 'X%' OR symbol IN (SELECT symbol FROM cur WHERE instrument_id IN (SELECT instrument_id FROM membership))) AND symbol NOT IN (SELECT symbol FROM cur WHERE figi IS NOT NULL)""",
    "enrich_figi": f"""WITH {UNIVERSE} SELECT symbol, CASE WHEN instrument_id % 3 <> 0 THEN 'MAP' || instrument_id ELSE figi END AS figi, CASE WHEN instrument_id % 3 <> 0 THEN 'US' || instrument_id END AS isin, substr(symbol, 1, 2) AS block,
        CAST((row_number() OVER (ORDER BY symbol) - 1) // 10 AS INT) AS batch_no FROM listing JOIN instrument USING (instrument_id) WHERE is_current""",
    "enrich_con_id": f"WITH {UNIVERSE} SELECT instrument_id, asset_class, CASE WHEN instrument_id % 4 = 0 THEN instrument_id WHEN asset_class = 'etf' THEN instrument_id + 3000 WHEN instrument_id % 2 = 0 THEN instrument_id + 1000 ELSE instrument_id + 2000 END AS con_id FROM instrument",
    "con_id_cache": f"WITH {UNIVERSE} SELECT symbol, CASE WHEN instrument_id % 3 = 0 THEN instrument_id + 5000 WHEN instrument_id % 2 = 0 THEN instrument_id + 1000 WHEN instrument_id % 5 <> 0 THEN instrument_id + 2000 END AS con_id, CASE WHEN instrument_id % 3 = 0 THEN 'cached' WHEN instrument_id % 2 = 0 OR instrument_id % 5 <> 0 THEN 'found' ELSE 'missing' END AS origin FROM sup",
    "assign_ids": f"WITH {UNIVERSE} SELECT symbol, exchange_mic, 1000 + row_number() OVER (ORDER BY symbol) AS instrument_id FROM listing WHERE is_current",
    "recover_ids": f"WITH {UNIVERSE}, r AS (SELECT symbol, CASE WHEN instrument_id % 9 <> 0 THEN exchange_mic END AS exchange_mic FROM listing) SELECT r.symbol, r.exchange_mic, l.instrument_id FROM r LEFT JOIN listing l ON l.is_current AND l.symbol = r.symbol AND l.exchange_mic IS NOT DISTINCT FROM r.exchange_mic",
    "membership_new": f"WITH {UNIVERSE}, w AS (SELECT instrument_id, 'SP500' AS universe_code FROM sup WHERE instrument_id % 2 = 0 OR instrument_id % 7 = 0 UNION SELECT instrument_id, 'NDX100' FROM sup WHERE instrument_id % 3 = 0 UNION SELECT instrument_id, 'R2K' FROM sup WHERE instrument_id % 5 = 0) SELECT * FROM w EXCEPT SELECT * FROM membership",
    "feed_config_new": f"WITH {UNIVERSE} SELECT instrument_id, asset_class FROM instrument WHERE instrument_id NOT IN (SELECT instrument_id FROM feed WHERE batch_group <> 'D')",
    "universe_summary": f"WITH {UNIVERSE} SELECT asset_class, count(*) AS total, count(*) FILTER (universe_code IS NOT NULL) AS in_universe, count(*) FILTER (f.instrument_id IS NOT NULL) AS active_feeds FROM instrument i LEFT JOIN membership m ON i.instrument_id = m.instrument_id LEFT JOIN feed f ON i.instrument_id = f.instrument_id AND f.is_active GROUP BY asset_class ORDER BY asset_class",
    "universe_summary_distinct": f"WITH {UNIVERSE} SELECT asset_class, count(DISTINCT i.instrument_id) AS total, count(DISTINCT m.instrument_id) AS in_universe, count(DISTINCT f.instrument_id) AS active_feeds FROM instrument i LEFT JOIN membership m ON i.instrument_id = m.instrument_id LEFT JOIN feed f ON i.instrument_id = f.instrument_id AND f.is_active GROUP BY asset_class ORDER BY asset_class",
    "feed_report": f"WITH {UNIVERSE} SELECT batch_group, priority, symbol, is_active FROM feed JOIN listing USING (instrument_id) WHERE is_current ORDER BY batch_group, priority, symbol",
    "instrument_update": f"WITH {UNIVERSE} SELECT instrument_id, CASE WHEN instrument_id % 5 = 1 THEN 'etf' ELSE asset_class END AS asset_class, figi FROM instrument",
    "listing_rename": f"""WITH {UNIVERSE}, l AS (SELECT *, is_current AND instrument_id % 25 = 0 AS hit FROM listing)
        SELECT instrument_id, symbol, exchange_mic, is_current AND NOT hit AS is_current, DATE '2000-01-01' AS valid_from, CASE WHEN hit THEN DATE '2024-02-01' END AS valid_to FROM l UNION ALL SELECT instrument_id, 'N' || instrument_id, exchange_mic, TRUE, DATE '2024-02-01', NULL FROM l WHERE hit""",
    "job_summary": f"""WITH {_RUN}, bs AS (SELECT symbol, count(*) FILTER (action = 'new') AS w, count(*) FILTER (action = 'amend') AS a, count(*) FILTER (action = 'skip') AS s FROM classified GROUP BY symbol), br AS (SELECT symbol, count(*) AS r FROM checked WHERE outcome = 'rejected' GROUP BY symbol), z AS (SELECT coalesce(w, 0) AS w, coalesce(a, 0) AS a, coalesce(s, 0) AS s, coalesce(r, 0) AS r FROM bs FULL JOIN br USING (symbol))
        SELECT count(*) AS total_symbols, CAST(sum(w) AS BIGINT) AS written, CAST(sum(a) AS BIGINT) AS amended, CAST(sum(s) AS BIGINT) AS skipped, CAST(sum(r) AS BIGINT) AS rejected, count(*) FILTER (w + a + s > 0) AS ok_symbols, round_even(count(*) FILTER (w + a + s > 0) / count(*) * 100, 1) AS success_rate_pct FROM z""",
    "run_report": f"""WITH {_RUN}, bs AS (SELECT symbol, count(*) FILTER (action = 'new') AS w, count(*) FILTER (action = 'amend') AS a, count(*) FILTER (action = 'skip') AS s, min(date) AS first_date, max(date) AS last_date FROM classified GROUP BY symbol), br AS (SELECT symbol, count(*) AS r FROM checked WHERE outcome = 'rejected' GROUP BY symbol)
        SELECT symbol, coalesce(w, 0) AS written, coalesce(a, 0) AS amended, coalesce(s, 0) AS skipped, first_date, last_date, coalesce(r, 0) AS rejected FROM bs FULL JOIN br USING (symbol)""",
    "planned_bars": f"WITH {PLANS} SELECT bars.symbol, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM bars JOIN plans ON bars.symbol = plans.symbol AND mode <> 'NO_OP' AND date BETWEEN start_date AND end_date GROUP BY bars.symbol",
    "table_tier": "WITH i AS (SELECT DISTINCT ['1d', '1h', '4h', '15m', '5m', '1m'][CAST(p_partkey % 6 + 1 AS INT)] AS interval FROM part) SELECT interval, CASE interval WHEN '1d' THEN 'daily' WHEN '1m' THEN 'tick' ELSE 'intraday' END AS tier, CASE WHEN interval = '1d' THEN 'symbol,date,interval' ELSE 'symbol,date,interval,bar_time_utc' END AS unique_key, interval <> '1d' AS is_intraday FROM i",
    "type_coercion": "SELECT CAST(o_orderkey AS VARCHAR) AS symbol, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS volume, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS open, CAST(NULL AS DOUBLE) AS close FROM orders",
    "provider_map_ibkr": f"""WITH {GATEWAY}, x AS (SELECT *, interval <> '1d' AS i, CASE interval WHEN '1h' THEN 60 ELSE 5 END AS mins FROM gt) SELECT symbol, CAST(utc AS DATE) AS date, interval, value AS open, value + 1 AS high, value - 1 AS low, value AS close, user_id AS volume, value AS adj_close, 'SMART' AS exchange, CASE WHEN i THEN strftime(utc, '%Y-%m-%dT%H:%M:%SZ') END AS bar_time_utc,
        CASE WHEN i THEN strftime({_LOCAL.format('utc')}, '%Y-%m-%dT%H:%M:%S') END AS bar_time_eastern, CASE WHEN i THEN strftime(utc + to_minutes(mins), '%Y-%m-%dT%H:%M:%SZ') END AS bar_end_time_utc, CASE WHEN i THEN 'America/New_York' END AS timezone_source FROM x""",
    "provider_map_yahoo": """SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS date, CASE WHEN event_id % 2 = 0 THEN '1d' ELSE '1h' END AS interval, value AS open, value AS close, user_id AS volume, CASE WHEN event_id % 20 = 0 THEN 0.25::DOUBLE END AS split_factor, CASE WHEN event_id % 15 = 0 THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS dividend_amount,
        CASE WHEN event_id % 15 = 0 THEN 'cash' END AS dividend_type, event_id % 15 = 0 AS is_ex_dividend_date, event_id % 20 = 0 AS is_ex_split_date, event_id % 15 = 0 OR event_id % 20 = 0 AS has_corporate_action, CASE WHEN event_id % 2 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS bar_time_utc FROM events""",
    "date_window": f"WITH {BARS} SELECT symbol, date, open FROM bars WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-01-31'",
    "quote_latest": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS n FROM events) SELECT upper(event_type) AS symbol, CASE WHEN event_id % 3 <> 0 AND event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS last, CAST(event_id AS DOUBLE) AS bid, CAST(NULL AS DOUBLE) AS ask, 7.0::DOUBLE AS volume, CAST(event_id * 2 AS DOUBLE) AS open, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS DOUBLE) END AS high, CAST(NULL AS DOUBLE) AS low FROM r WHERE n = 1",
    "period_codes": "WITH d AS (SELECT DISTINCT p_size * 20 - 15 AS days FROM part) SELECT days, CASE WHEN days <= 30 THEN days || 'd' WHEN days <= 365 THEN greatest(1, days // 7) || 'w' ELSE greatest(1, days // 30) || 'm' END AS period FROM d",
    "provider_capabilities": "WITH p AS (SELECT ['1d', '1h', '4h', '15m', '5m', '1m'][CAST(p_partkey % 6 + 1 AS INT)] AS interval, count(*) AS n FROM part GROUP BY 1) SELECT t.*, n FROM p JOIN (VALUES ('ibkr', '1d', TRUE, TRUE, '1d'), ('ibkr', '1h', TRUE, TRUE, '1h'), ('ibkr', '4h', TRUE, TRUE, '4h'), ('ibkr', '5m', TRUE, TRUE, '5mins'), ('ibkr', '1m', TRUE, TRUE, '1min'), ('yahoo', '1d', FALSE, FALSE, '1d'), ('yahoo', '1h', FALSE, FALSE, '1h'), ('yahoo', '5m', FALSE, FALSE, '5mins'), ('yahoo', '1m', FALSE, FALSE, '1min')) t(provider, interval, options, realtime, bar_code) USING (interval)",
    "zero_volume_runs": f"WITH {BARS}, z AS (SELECT symbol, interval, date, volume <= 0 AS zero, row_number() {_SEQ} - row_number() OVER (PARTITION BY symbol, interval, volume <= 0 ORDER BY date) AS island FROM bars) SELECT symbol, interval, min(date) AS run_start, max(date) AS run_end, count(*) AS n_bars FROM z WHERE zero GROUP BY symbol, interval, island",
    "price_spike": f"""WITH {BARS}, c AS (SELECT *, CAST(round(close * 100) AS BIGINT) AS cents FROM bars), w AS (SELECT *, count(cents) OVER win AS n, CAST(sum(cents) OVER win AS DOUBLE) AS s, CAST(sum(CAST(cents * cents AS HUGEINT)) OVER win AS DOUBLE) AS q FROM c WINDOW win AS (PARTITION BY symbol, interval ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
        SELECT symbol, date, close FROM w WHERE n = 20 AND pow(CAST(cents AS DOUBLE) * 20 - s, 2) > 4.0 * (q * 20 - pow(s, 2))""",
    "bar_spacing": f"WITH {HOURLY}, g AS (SELECT symbol, bar, date_diff('minute', lag(bar) OVER (PARTITION BY symbol ORDER BY bar), bar) AS gap_minutes FROM hourly) SELECT symbol, '1h' AS interval, strftime(bar, '%Y-%m-%d %H:%M:%S') AS bar_time, gap_minutes FROM g WHERE gap_minutes <> 60",
    "session_rule": f"WITH {GATEWAY} SELECT 'bar_within_market_hours' AS rule, 'warning' AS severity, count(*) AS hits FROM gt WHERE interval = '1h' AND strftime({_LOCAL.format('utc')}, '%H:%M') NOT BETWEEN '09:30' AND '15:59'",
    "indicators": f"""WITH {BARS}, c AS (SELECT *, close - lag(close) {_SEQ} AS ch, row_number() {_SEQ} AS seen FROM bars), g AS (SELECT *, CAST(greatest(ch, 0.0) AS DECIMAL(18,6)) AS gain, CAST(greatest(-ch, 0.0) AS DECIMAL(18,6)) AS loss FROM c),
        w AS (SELECT *, CAST(sum(CAST(close AS DECIMAL(18,6))) {_over(15)} AS DOUBLE) / 15 AS a, CAST(sum(CAST(close AS DECIMAL(18,6))) {_over(45)} AS DOUBLE) / 45 AS b45, sum(volume) {_over(20)} / 20 AS v, CAST(sum(gain) {_over(14)} AS DOUBLE) AS gs, CAST(sum(loss) {_over(14)} AS DOUBLE) AS ls,
          min(low) {_over(14)} AS lo, max(high) {_over(14)} AS hi, max(high) {_over(80)} AS h80, min(low) {_over(15)} AS s15 FROM g)
        SELECT symbol, interval, date, close, CASE WHEN seen >= 15 THEN a END AS sma_15, CASE WHEN seen >= 45 THEN b45 END AS sma_45, CASE WHEN seen >= 20 THEN v END AS avg_volume_20, CASE WHEN seen >= 15 THEN CASE WHEN ls = 0 THEN 100.0 ELSE 100 - 100 / (1 + gs / ls) END END AS rsi_14,
          CASE WHEN seen >= 14 AND hi > lo THEN (close - lo) / (hi - lo) * 100 END AS stoch_k, CASE WHEN seen >= 80 THEN h80 END AS high_80, CASE WHEN seen >= 15 THEN s15 END AS support_15 FROM w""",
    "rule_errors": f"""WITH {BARS}, x AS (SELECT volume % 7 = 0 AS l, volume % 11 = 0 AS w, low, high, open, close, vwap FROM bars), r AS (
          SELECT unnest([CASE WHEN l THEN 'high_gte_low' END, CASE WHEN l THEN 'low_lte_open' END, CASE WHEN l THEN 'low_lte_close' END, CASE WHEN l THEN 'price_positive' END,
            CASE WHEN w OR l AND NOT vwap > high + 1e-9 THEN 'vwap_between_low_and_high' END]) AS rule FROM x)
        SELECT rule, 'warning' AS severity, 'flag_record' AS action, count(*) AS hits FROM r WHERE rule IS NOT NULL GROUP BY rule""",
    "trend": f"""WITH RECURSIVE {BARS}, c AS (SELECT *, lag(close) {_SEQ} AS pc, row_number() {_SEQ} AS n, min(low) {_over(14)} AS lo, max(high) {_over(14)} AS hi FROM bars WHERE high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL),
        k AS (SELECT symbol, interval, date, n, close, greatest(abs(high - low), abs(high - pc), abs(low - pc)) AS tr, CAST(CASE WHEN n >= 14 AND hi > lo THEN (close - lo) / (hi - lo) * 100 END AS DECIMAL(20,8)) AS sk FROM c),
        d AS (SELECT *, CASE WHEN count(sk) {_over(3)} = 3 THEN CAST(sum(sk) {_over(3)} AS DOUBLE) / 3 END AS sd FROM k),
        e AS (SELECT symbol, interval, n, close AS a, close AS b, close AS f, close AS s, tr AS t, CAST(0.0 AS DOUBLE) AS g FROM d WHERE n = 1
          UNION ALL SELECT symbol, interval, n, a, b, f, s, t, g + (f - s - g) * 0.2::DOUBLE FROM (SELECT d.symbol, d.interval, d.n, e.a + (d.close - e.a) / 8 AS a, e.b + (d.close - e.b) / 23 AS b, e.f + (d.close - e.f) * 2 / 13 AS f, e.s + (d.close - e.s) * 2 / 27 AS s, e.t + (d.tr - e.t) / 14 AS t, e.g
            FROM e JOIN d ON d.symbol = e.symbol AND d.interval = e.interval AND d.n = e.n + 1))
        SELECT d.symbol, d.interval, d.date, round(a, 4) AS ema_15, round(b, 4) AS ema_45, round(f - s, 4) AS macd, round(g, 4) AS macd_signal, round(t, 4) AS atr_14, round(sd, 4) AS stoch_d FROM d JOIN e ON d.symbol = e.symbol AND d.interval = e.interval AND d.n = e.n""",
    "command_effects": f"WITH {UNIVERSE}, {COMMANDS} SELECT f.instrument_id, c.command_id, CASE WHEN c.command IS NULL THEN CASE WHEN f.is_active THEN 'active' ELSE 'paused' END ELSE CASE c.command WHEN 'FORCE_RELOAD' THEN 'reload' WHEN 'HISTORY_LOAD' THEN 'extend' WHEN 'PAUSE' THEN 'paused' WHEN 'RESUME' THEN 'active' ELSE 'skip' END END AS effect FROM feed f LEFT JOIN commands c ON f.instrument_id = c.instrument_id AND c.status = 'PENDING'",
    "command_consume": f"WITH {SUP}, {COMMANDS} SELECT command_id, instrument_id, command, 'DONE' AS status, CASE WHEN status = 'PENDING' THEN 'now' END AS consumed_at FROM commands",
    "batch_scope": f"""WITH {UNIVERSE}, bc(job_type, groups, cap) AS (VALUES ('daily_ab', 'AB', 5), ('daily_c', 'C', NULL), ('daily_d', 'D', 3)), r AS (SELECT job_type, batch_group, instrument_id, priority, cap, CAST(row_number() OVER (PARTITION BY job_type ORDER BY priority, instrument_id) AS INT) AS place FROM bc JOIN feed ON contains(groups, batch_group) AND is_active)
        SELECT job_type, batch_group, instrument_id, priority, place FROM r WHERE cap IS NULL OR place <= cap""",
    "last_success": "SELECT o_custkey AS instrument_id, max(CAST(o_orderdate AS DATE)) AS last_success FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey",
    "recent_failures": "SELECT CAST(o_orderdate AS DATE) AS completed_at, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' AND CAST(o_orderdate AS DATE) >= DATE '1998-06-23' GROUP BY 1",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("region", "nation", "supplier", "part", "orders")),
    "constraint_checks": f"WITH {UNIVERSE} SELECT 'not_null_symbol' AS constraint_name, count(*) FILTER (symbol IS NULL) AS violations FROM listing UNION ALL SELECT 'not_null_exchange_mic', count(*) FILTER (exchange_mic IS NULL) FROM listing UNION ALL SELECT 'unique_instrument_id', count(*) FROM (SELECT instrument_id FROM listing GROUP BY 1 HAVING count(*) > 1)",
}


_CHUNKS = f"""{BARS}, syms AS (SELECT DISTINCT sid FROM b),
ch AS (SELECT sid, CAST(c AS INT) AS c, CAST(DATE '1999-01-01' + CAST(30 * c AS INT) AS DATE) AS a, least(CAST(DATE '1999-01-01' + CAST(30 * c + 29 AS INT) AS DATE), DATE '1999-12-31') AS z FROM syms, generate_series(0, 12) g(c) WHERE sid <> 9),
st AS (SELECT *, CASE WHEN (sid + c) % 11 = 3 THEN 'FileNotFoundError' WHEN sid = 7 OR (sid + c) % 7 = 0 THEN 'ValueError' END AS err FROM ch),
mapped AS (SELECT bars.* REPLACE (CAST(NULL AS DOUBLE) AS vwap, CAST(NULL AS DOUBLE) AS prev_close), st.* FROM bars JOIN st ON CAST(substr(symbol, 2) AS INT) = sid AND date BETWEEN a AND z WHERE sid <> 8 AND close IS NOT NULL),
got AS (SELECT * FROM mapped WHERE err IS NULL), {_checked("got")},
judged AS (SELECT *, outcome = 'rejected' OR isodow(date) > 5 AS bad FROM checked)"""
_AGAIN = _checked("got2").replace("f AS (", "f2 AS (").replace("checked AS (", "checked2 AS (").replace("FROM f)", "FROM f2)")
_TWICE = f"""{_CHUNKS}, got2 AS (SELECT * REPLACE (CASE WHEN volume % 10 = 0 THEN close + 0.5 ELSE close END AS close) FROM mapped), {_AGAIN},
first AS (SELECT * FROM judged WHERE NOT bad), second AS (SELECT * FROM checked2 WHERE outcome <> 'rejected' AND isodow(date) < 6),
kept AS (SELECT symbol, date, 'b1' AS batch_id, 1 AS record_version, FALSE AS is_amended FROM first UNION ALL
  SELECT s.symbol, s.date, 'b2', CASE WHEN f.symbol IS NULL THEN 1 ELSE 2 END, f.symbol IS NOT NULL FROM second s LEFT JOIN first f ON s.symbol = f.symbol AND s.date = f.date WHERE f.symbol IS NULL OR abs(s.close - f.close) > 0.001)"""
_REPORT = f"""WITH {_CHUNKS}, bc AS (SELECT sid, count(*) AS landed, count(*) FILTER (NOT bad) AS written, count(*) FILTER (bad) AS rejected FROM judged GROUP BY sid),
fc AS (SELECT sid, count(err) AS failed_chunks, arg_min(err, a) FILTER (err IS NOT NULL) AS error FROM st GROUP BY sid),
rep AS (SELECT 'S' || sid AS symbol, CASE WHEN sid = 9 THEN 'NO_OP' ELSE 'EXPLICIT_DATE_RANGE' END AS mode, coalesce(landed, 0) AS landed, coalesce(written, 0) AS written, 0 AS amended, 0 AS unchanged, coalesce(rejected, 0) AS rejected,
  coalesce(failed_chunks, 0) AS failed_chunks, error, CASE WHEN sid = 9 THEN 'skipped' WHEN error IS NOT NULL AND landed > 0 THEN 'partial' WHEN error IS NOT NULL THEN 'failed' WHEN landed > 0 THEN 'success' ELSE 'no_data' END AS status
  FROM syms LEFT JOIN bc USING (sid) LEFT JOIN fc USING (sid))"""
ORACLE_SQL |= {
    "run_job_report": f"{_REPORT} SELECT * FROM rep",
    "run_job_summary": f"""{_REPORT} SELECT count(*) AS total_symbols, count(*) FILTER (status IN ('success', 'partial')) AS successful_symbols, count(*) FILTER (status = 'partial') AS partial_symbols,
  count(*) FILTER (status IN ('skipped', 'no_data')) AS skipped_symbols, count(*) FILTER (status = 'failed') AS failed_symbols, CAST(sum(landed) AS BIGINT) AS landed, CAST(sum(written) AS BIGINT) AS written, 0 AS amended, 0 AS unchanged,
  CAST(sum(rejected) AS BIGINT) AS rejected, CAST(sum(failed_chunks) AS BIGINT) AS failed_chunks, round_even((count(*) - count(*) FILTER (status = 'failed')) / count(*) * 100, 1) AS success_rate_pct FROM rep""",
    "run_job_hits": f"""WITH {_CHUNKS}, x AS (SELECT unnest(fired) AS rule FROM judged UNION ALL SELECT 'no_weekend_dates' FROM judged WHERE isodow(date) > 5)
  SELECT rule, CASE WHEN rule IN ('volume_positive', 'price_change_pct_threshold', 'gap_threshold') THEN 'warning' ELSE 'critical' END AS severity, count(*) AS hits FROM x GROUP BY rule""",
    "chunk_failures": f"WITH {_CHUNKS} SELECT 'S' || sid AS symbol, '1d' AS interval, c AS chunk, a AS chunk_start, z AS chunk_end, err AS error FROM st WHERE err IS NOT NULL",
    "write_batch": f"WITH {_TWICE} SELECT symbol, batch_id, record_version, is_amended, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM kept GROUP BY ALL",
    "watermarks_after_run": f"""WITH {_TWICE}, w AS (SELECT symbol, min(date) AS earliest_date, max(date) AS latest_date, max(batch_id) AS batch_id FROM kept GROUP BY symbol)
  SELECT CAST(substr(symbol, 2) AS BIGINT) + 1 AS instrument_id, earliest_date, latest_date, batch_id, 'EXPLICIT_DATE_RANGE' AS mode, 'active' AS status, 0 AS consecutive_failures FROM w
  UNION ALL SELECT sid + 1, NULL, NULL, NULL, NULL, 'suspended', NULL FROM syms WHERE sid = 9""",
    "silver_refresh": ORACLE_SQL["silver_latest"],
    "listing_as_of": f"""WITH {BARS}, n AS (SELECT CAST(substr(symbol, 2) AS BIGINT) AS instrument_id, date FROM bars),
  s AS (SELECT *, CASE WHEN instrument_id % 5 = 0 THEN CASE WHEN date < DATE '1997-03-10' THEN 'OLD' WHEN date < DATE '1997-11-03' THEN 'MID' ELSE 'NEW' END || instrument_id
    WHEN instrument_id = 3 AND date < DATE '1999-07-01' THEN NULL ELSE 'S' || instrument_id END AS symbol FROM n)
  SELECT instrument_id, symbol, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM s GROUP BY instrument_id, symbol""",
    "rejects_reprocessed": f"""WITH {CHECKED}, r AS (SELECT *, len(list_filter(crit, lambda x: x <> 'vwap_between_low_and_high')) = 0 AS ok FROM checked WHERE outcome = 'rejected')
  SELECT symbol, CAST(date AS VARCHAR) AS date, crit[1] AS rejected_rule, ok AS reprocessed, CASE WHEN ok THEN '2026-01-03T03:04:05Z' END AS reprocessed_at, CASE WHEN ok THEN 'b2' END AS reprocessed_batch FROM r""",
    "validation_compact": f"""WITH {CHECKED}, s AS (SELECT symbol, interval, count(*) AS total_input, count(*) FILTER (outcome = 'rejected') AS total_rejected, round_even(count(*) FILTER (outcome = 'clean') / count(*) * 100, 1) AS pass_rate_pct FROM checked GROUP BY 1, 2),
  h AS (SELECT symbol, interval, rule, count(*) AS hits FROM (SELECT symbol, interval, unnest(fired) AS rule FROM checked) GROUP BY 1, 2, 3) SELECT * FROM s JOIN h USING (symbol, interval)""",
    "foreign_keys": """WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 50 = 0 THEN -1 ELSE l_partkey END AS part, CASE WHEN l_orderkey % 70 <> 0 THEN l_suppkey END AS supplier,
    CASE WHEN l_orderkey % 90 = 0 THEN 1 ELSE l_linenumber END AS line FROM lineitem), w AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, line) AS n FROM r)
  SELECT l_orderkey, l_linenumber, 'not_null_supplier' AS constraint_name FROM w WHERE supplier IS NULL UNION ALL SELECT l_orderkey, l_linenumber, 'unique_l_orderkey_line' FROM w WHERE n > 1
  UNION ALL SELECT l_orderkey, l_linenumber, 'foreign_part' FROM w WHERE part NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT l_orderkey, l_linenumber, 'foreign_supplier' FROM w WHERE supplier NOT IN (SELECT s_suppkey FROM supplier)""",
    "change_feed_silver": ORACLE_SQL["silver_latest"],
    "change_feed_counts": f"""WITH {HISTORY}, {_classified()}, a AS (SELECT date, interval, 'b0' AS batch_id FROM stored UNION ALL SELECT date, interval, 'b1' FROM classified WHERE action = 'amend')
  SELECT batch_id, interval, count(*) AS n_bars, min(date) AS first_date, max(date) AS last_date FROM a GROUP BY batch_id, interval""",
}
_SEVERITY = "CASE rule " + " ".join(f"WHEN '{n}' THEN '{v}'" for n, v, _ in _RULES) + " ELSE 'warning' END"
_HITS = "SELECT rule, " + _SEVERITY + " AS severity, count(*) AS hits FROM x GROUP BY rule"
ORACLE_SQL |= {
    "provider_read_yahoo": """SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS date, 'yahoo' AS source, event_id % 15 = 0 AS has_corporate_action, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS volume, max(value) AS close
  FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' GROUP BY ALL""",
    "etf_csv": "SELECT 'P' || p_partkey AS symbol, 'SP500' AS universe_codes, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) / 100 END AS weight, p_name || ', Inc' AS company_name, TRUE AS is_active FROM part WHERE p_partkey % 100 <> 0",
    "ticker_seed": """SELECT 'S' || s_suppkey AS symbol, s_name AS name, s_suppkey % 3 <> 0 AS active, CASE WHEN s_suppkey % 4 <> 0 THEN DATE '2020-02-03' END AS added_date,
  CASE WHEN s_suppkey % 5 <> 0 THEN 1.5 END AS min_price, CAST(NULL AS DATE) AS history_start, CAST(NULL AS DATE) AS ipo_date, 'n' AS notes FROM supplier""",
    "strategy_seed": "SELECT n_name AS strategy, 'rsi|ema' || n_regionkey || '|macd' AS entry_indicators FROM nation",
    "raw_landing": ORACLE_SQL["listing_parse_nasdaq"],
    "threshold_override": "WITH " + CHECKED.replace("* 100 > 50", "* 100 > 20").replace("* 100 > 15", "* 100 > 5") + f", x AS (SELECT unnest(fired) AS rule FROM checked) {_HITS}",
    "trade_count_rule": f"WITH {CHECKED}, x AS (SELECT unnest(fired) AS rule FROM checked UNION ALL SELECT 'trade_count_positive' FROM checked WHERE volume % 9 IN (7, 8)) {_HITS}",
    "seed_if_empty": f"WITH {UNIVERSE} SELECT instrument_id, asset_class, figi, 'true,true,false,false' AS made FROM instrument",
    "append_batches": f"WITH {UNIVERSE} SELECT batch_group, is_active, count(*) AS n, CAST(sum(instrument_id) AS BIGINT) AS ids FROM feed GROUP BY ALL",
    "new_preview": f"WITH {UNIVERSE}, {INCOMING_SYMBOLS}, n AS (SELECT symbol FROM inc WHERE symbol NOT IN (SELECT symbol FROM listing WHERE is_current)) SELECT symbol, (SELECT count(*) FROM n) AS n_new FROM n ORDER BY symbol LIMIT 5",
}
