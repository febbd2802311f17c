"""Each rule fires, passes, and passes on nulls; batches split three ways."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.config import STREAMS
from tidemark.functions import rules as R
from tidemark.operators import validate as V

SCHEMA = "symbol string, date date, interval string, source string, open double, high double, low double, close double, volume long, prev_close double, vwap double, trade_count long, pre_market_volume long, fetch_duration_ms long, is_amended boolean"
VALID = dict(symbol="AAPL", date=date(2026, 6, 19), interval="1d", source="ibkr", open=150.0, high=152.5, low=149.75, close=151.25, volume=1_000_000, prev_close=149.5, vwap=150.87, trade_count=45230, pre_market_volume=125000, fetch_duration_ms=245, is_amended=False)


def bars(spark, *changes):
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple({**VALID, **c}[n] for n in names) for c in changes], SCHEMA)


CASES = [
    ({}, []),
    ({"high": 148.0}, ["high_gte_low", "high_gte_open", "high_gte_close", "vwap_between_low_and_high"]),
    ({"high": 149.0, "vwap": None, "low": 148.0}, ["high_gte_open", "high_gte_close"]),
    ({"high": 150.0, "vwap": None}, ["high_gte_close"]),
    ({"low": 151.0, "vwap": None}, ["low_lte_open"]),
    ({"low": 152.0, "vwap": None}, ["low_lte_open", "low_lte_close"]),
    ({"volume": 0}, ["volume_positive"]),
    ({"volume": None}, ["no_null_ohlcv"]),
    ({"open": None}, ["no_null_ohlcv"]),
    ({"open": -1.0, "low": 149.75}, ["low_lte_open", "price_positive", "gap_threshold"]),
    ({"prev_close": 100.0, "close": 160.0, "high": 170.0, "open": 101.0, "low": 100.5}, ["price_change_pct_threshold"]),
    ({"prev_close": 0.0}, ["prev_close_positive"]),
    ({"vwap": 200.0}, ["vwap_between_low_and_high"]),
    ({"vwap": None}, []),
    ({"vwap": float("nan")}, []),
    ({"prev_close": 100.0, "open": 120.0, "low": 110.0, "close": 121.0, "vwap": 121.0}, ["gap_threshold"]),
    ({"pre_market_volume": -100}, ["pre_market_volume_non_negative"]),
    ({"fetch_duration_ms": 40000}, ["fetch_duration_threshold"]),
    ({"is_amended": True}, ["amended_record_detected"]),
]


def test_each_rule(spark):
    frame = bars(spark, *[c for c, _ in CASES]).withColumn("n", F.monotonically_increasing_id())
    found = frame.select("n", R.fired(frame, R.rule_set()).alias("f")).orderBy("n").collect()
    for (change, want), row in zip(CASES, found, strict=True):
        assert [x.rule for x in row.f] == want, change
        assert all(x.message for x in row.f)


def test_weekend_rule_is_the_daily_streams(spark):
    frame = bars(spark, {"date": date(2026, 6, 20)}, {"date": date(2026, 6, 21)}, {})
    assert V.validate(frame).where("outcome = 'clean'").count() == 3
    checked = V.validate(frame, STREAMS["daily"])
    assert [r.deciding_rule for r in checked.orderBy("date").collect()] == [None, "no_weekend_dates", "no_weekend_dates"]


def test_weekend_rule_on_text(spark):
    frame = spark.createDataFrame([("2026-02-30",), ("2026-6-1",), ("2026-06-19",), (None,)], "date string")
    fires = frame.select(R.REGISTRY["no_weekend_dates"](R.Bar(frame), None).isNotNull().alias("x")).collect()
    assert [r.x for r in fires] == [True, True, False, False]


def test_corporate_actions(spark):
    rows = [(True, None, False, 0.0, False), (False, None, True, 0.0, False), (False, None, False, 0.0, True), (True, 0.25, True, 0.5, True), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "is_ex_split_date boolean, split_factor double, is_ex_dividend_date boolean, dividend_amount double, has_corporate_action boolean")
    found = frame.select(R.REGISTRY["corporate_action_consistency"](R.Bar(frame), None).alias("m")).collect()
    assert [bool(r.m) for r in found] == [True, True, True, False, False]


def test_three_ways_and_rates(spark):
    checked = V.validate(bars(spark, {}, {"high": 148.0}, {"volume": 0}))
    row = V.summary(checked).first()
    assert (row.total_passed, row.total_flagged, row.total_rejected) == (1, 1, 1)
    assert (row.pass_rate_pct, row.rejection_rate_pct) == (33.3, 33.3)
    rejected = V.rejected_records(checked, "b", "v").first()
    assert rejected.rejected_rule == "high_gte_low" and '"pre_market_volume"' in rejected.raw_record and rejected.date == "2026-06-19"
    assert {(r.rule, r.outcome) for r in V.audit_log(checked).collect()} >= {("volume_positive", "flagged"), ("high_gte_low", "rejected")}


def test_empty_batch(spark):
    row = V.summary(V.validate(bars(spark, {}).limit(0)), by=()).first()
    assert (row.total_input, row.pass_rate_pct, row.rejection_rate_pct) == (0, 100.0, 0.0)


def test_rule_sets():
    daily = [r.name for r in R.rule_set(STREAMS["daily"])]
    assert len(daily) == len(set(daily)) == 18 and daily[-1] == "no_weekend_dates"
    tick = {r.name: r for r in R.rule_set(STREAMS["tick"])}
    assert tick["fetch_duration_threshold"].threshold == 10000.0
    from dataclasses import replace

    with pytest.raises(ValueError):
        R.rule_set(replace(STREAMS["daily"], additional_rules=(("nonsense", "critical", "reject_record"),)))
    assert "gap_threshold" not in [r.name for r in R.rule_set(replace(STREAMS["daily"], disabled_rules=("gap_threshold",)))]


def test_enrich_and_completeness(spark):
    checked = V.validate(bars(spark, {}, {"volume": 0, "source": "yahoo", "vwap": None, "trade_count": None}))
    made = {r.source: r for r in V.enrich(checked, "b1", "v1", nullable=STREAMS["daily"].nullable).collect()}
    assert made["ibkr"].data_quality_reasons == "[]" and made["yahoo"].data_quality_reasons == '["volume_positive"]'
    assert made["ibkr"].data_completeness_pct == 78.0  # 7 of 8 core, 2 of 5 optional
    assert made["yahoo"].data_completeness_pct == 68.6  # 6 of 7 core; of the optional ones only shares_outstanding counts, and it is missing
    assert made["ibkr"].record_version == 1 and made["ibkr"].unadj_close == 151.25


def test_continuity(spark):
    days = [date(2026, 1, d) for d in (1, 2, 5, 14, 15)] + [date(2026, 2, 1)]
    frame = spark.createDataFrame([("A", d, "1d") for d in days] + [("B", days[0], "1d")], "symbol string, date date, interval string")
    row = V.continuity_alerts(frame).collect()
    assert [(r.symbol, r.gap_start, r.missing_days) for r in row] == [("A", date(2026, 1, 15), 15)]


def test_rule_that_cannot_be_evaluated_warns(spark):
    """Text in place of a price: critical rules that need it warn, those that don't still reject, numbers as text are read."""
    frame = bars(spark, {}, {"high": 148.0}).withColumns({"low": F.lit("n/a"), "volume": F.lit("12")})
    plain, crossed = V.validate(frame).orderBy(F.col("high").desc()).collect()
    assert plain.outcome == "flagged"
    assert {(x.rule, x.severity, x.action) for x in plain.fired} == {(n, "warning", "flag_record") for n in ("high_gte_low", "low_lte_open", "low_lte_close", "price_positive", "vwap_between_low_and_high")}
    assert all(x.message.startswith("Rule evaluation error: low") for x in plain.fired)
    assert crossed.outcome == "rejected" and crossed.deciding_rule == "high_gte_open"
