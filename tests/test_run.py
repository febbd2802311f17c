"""Whole runs: plans, provider, failures, replays and deaths on the way."""

import json
from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.config import STREAMS
from tidemark.operators import validate as V
from tidemark.plans import job
from tidemark.plans import planner as P
from tidemark.plans.run import run_job
from tidemark.sources import etf
from tidemark.store import TableStore
from test_history import bars

TODAY = date(2026, 6, 18)
CFG = P.PlanConfig(STREAMS["daily"])


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def tickers(spark, *symbols):
    return spark.createDataFrame([(s, i, None) for i, s in enumerate(symbols, 1)], "symbol string, instrument_id long, history_start date")


def landed(tmp_path, name, *rows):
    path = tmp_path / f"{name}.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def gateway(symbol, day, close=10.0, high=11.0):
    from datetime import datetime, timezone

    t = int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp() * 1000)
    return {"symbol": symbol, "interval": "1d", "t": t, "o": 10.0, "h": high, "l": 9.0, "c": close, "v": 100.0}


def statuses(run):
    return {r.symbol: r.status for r in run.report.collect()}


def test_run_plans_ingests_and_reports(spark, store, tmp_path):
    path = landed(tmp_path, "a", gateway("A", "2026-06-17"), gateway("A", "2001-01-02"), gateway("B", "2026-06-16"), gateway("B", "2026-06-17", high=1.0), gateway("X", "2026-06-17"))
    who = tickers(spark, "A", "B", "C")
    first = run_job(store, {"ibkr": path}, who, CFG, TODAY, "b1", "v1")
    assert first.provider == "ibkr" and {r.mode for r in first.plans.collect()} == {"INITIAL_LOAD"} and first.requests.count() > 3 * 100
    assert statuses(first) == {"A": "success", "B": "success", "C": "no_data"}
    total = first.summary.first()
    assert (total.written, total.rejected) == (2, 1)
    table = store.read("market_data_daily", S.BARS_SCHEMA).collect()
    assert {(r.symbol, str(r.date), r.ingestion_type, r.batch_id) for r in table} == {("A", "2026-06-17", "backfill", "b1"), ("B", "2026-06-16", "backfill", "b1")}
    marks = {r.instrument_id: r for r in store.read("ingestion_watermark").collect()}
    assert set(marks) == {1, 2} and {m.mode for m in marks.values()} == {"INITIAL_LOAD"}


def test_up_to_date_symbols_are_skipped(spark, store, tmp_path):
    path = landed(tmp_path, "a", gateway("A", "2026-06-18"), gateway("B", "2026-06-16"))
    who = tickers(spark, "A", "B")
    run_job(store, {"ibkr": path}, who, CFG, TODAY, "b1")
    again = run_job(store, {"ibkr": path}, who, CFG, TODAY, "b2")
    assert statuses(again) == {"A": "skipped", "B": "success"} and again.summary.first().written == 0
    assert {r.symbol: r.unchanged for r in again.report.collect()} == {"A": 0, "B": 1}
    forced = run_job(store, {"ibkr": path}, who, CFG, TODAY, "b3", start=date(2026, 6, 1), end=date(2026, 6, 18))
    assert {(r.mode, r.is_amendment_run, r.estimated_batches, r.date_range_days) for r in forced.plans.collect()} == {("EXPLICIT_DATE_RANGE", False, 1, 18)}


def test_dry_run_and_no_tickers(spark, store, tmp_path):
    path = landed(tmp_path, "a", gateway("A", "2026-06-17"))
    dry = run_job(store, {"ibkr": path}, tickers(spark, "A"), CFG, TODAY, "b1", dry_run=True)
    assert dry.plans.count() == 1 and dry.summary is None and not store.exists("market_data_daily")
    none = run_job(store, {"ibkr": path}, tickers(spark, "A").limit(0), CFG, TODAY, "b1")
    assert none.report.count() == 0 and none.summary.first().total_symbols == 0


def test_fallback_provider(spark, store, tmp_path):
    yahoo = tmp_path / "y.parquet"
    spark.sql("SELECT 'A' AS symbol, '1d' AS interval, TIMESTAMP '2026-06-17 00:00:00' AS ts, 10D AS Open, 11D AS High, 9D AS Low, 10D AS Close, 5L AS Volume, 0D AS Dividends, 0D AS `Stock Splits`").write.parquet(str(yahoo))
    made = run_job(store, {"ibkr": str(tmp_path / "gone.parquet"), "yahoo": str(yahoo)}, tickers(spark, "A"), CFG, TODAY, "b1")
    assert made.provider == "yahoo" and store.read("market_data_daily").first().source == "yahoo"
    with pytest.raises(RuntimeError, match="no provider"):
        run_job(store, {"ibkr": str(tmp_path / "gone.parquet")}, tickers(spark, "A"), CFG, TODAY, "b2")


def test_failures_count_and_suspend(spark, store, tmp_path):
    who = tickers(spark, "A", "B")
    run_job(store, {"ibkr": landed(tmp_path, "a", gateway("A", "2026-06-10"), gateway("B", "2026-06-10"))}, who, CFG, TODAY, "b0")
    failed = spark.createDataFrame([("A", "Connection error")], "symbol string, error string")
    for n, day in ((1, "2026-06-11"), (2, "2026-06-12"), (3, "2026-06-15")):
        path = landed(tmp_path, f"c{n}", gateway("B", day))
        made = run_job(store, {"ibkr": path}, who, CFG, TODAY, f"b{n}", failures=failed)
        if n == 2:  # a batch that is run again counts once
            run_job(store, {"ibkr": path}, who, CFG, TODAY, "b2", failures=failed)
        assert statuses(made) == {"A": "failed", "B": "success"} and {r.error for r in made.report.collect()} == {"Connection error", None}
        mark = {r.instrument_id: r for r in store.read("ingestion_watermark").collect()}
        assert (mark[1].consecutive_failures, str(mark[1].latest_date)) == (n, "2026-06-10") and (mark[2].consecutive_failures, str(mark[2].latest_date)) == (0, day)
    assert mark[1].status == "suspended"
    assert statuses(run_job(store, {"ibkr": path}, who, CFG, TODAY, "b9"))["A"] == "skipped"


@pytest.mark.parametrize("dies_at", ["append:market_data_rejected", "replace:ingestion_watermark", "append:market_data_daily"])
def test_batch_that_died_is_run_again(spark, store, dies_at):
    ids = spark.createDataFrame([("AAPL", 1), ("B", 2)], "symbol string, instrument_id long")
    batch = bars(spark, {}, {"symbol": "B"}, *[{"symbol": "B", "date": date(2026, 6, 18), "high": 1.0}] * 2, {"symbol": "B", "date": date(2026, 6, 16), "high": 2.0})
    how, table = dies_at.split(":")

    class Dies(TableStore):
        def append(self, name, *a):
            if dies_at == f"append:{name}":
                raise OSError("lost")
            super().append(name, *a)

        def replace(self, name, *a):
            if dies_at == f"replace:{name}":
                raise OSError("lost")
            super().replace(name, *a)

    with pytest.raises(OSError, match="lost"):
        job.ingest(Dies(spark, store.root), batch, STREAMS["daily"], "b1", "v1", ids, now=F.lit("2026-06-18").cast("timestamp"))
    for _ in range(3):
        job.ingest(store, batch, STREAMS["daily"], "b1", "v1", ids)
    assert store.read("market_data_daily").count() == 2 and store.read("market_data_rejected").count() == 3
    marks = {r.instrument_id: r for r in store.read("ingestion_watermark").collect()}
    assert {m.batch_id for m in marks.values()} == {"b1"} and set(marks) == {1, 2} and all(m.consecutive_failures == 0 for m in marks.values())


def test_stored_history_is_pruned(spark, store):
    rows = bars(spark, *[{"date": date(2026, m, 15 + (m == 2) + 2 * (m == 3))} for m in (1, 2, 3, 4, 5, 6)])
    job.ingest(store, rows, STREAMS["daily"], "b1")
    few = job.stored_bars(store, "market_data_daily", [("1d", "2026-05"), ("1d", "2026-06")])
    assert few.count() == 2
    filters = few._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "IN (2026-05,2026-06)" in filters and "interval" in filters
    files = store.read("market_data_daily").select("_metadata.file_path").distinct().count()
    assert files == 6  # one for each month, whatever the tasks
    again = job.ingest(store, bars(spark, {"date": date(2026, 5, 15), "close": 152.0}, {"date": date(2026, 6, 15)}), STREAMS["daily"], "b2").first()
    assert (again.amended, again.skipped, again.written) == (1, 1, 0)


def test_order_alerts_use_the_streams_limits(spark):
    rows = bars(spark, *[{"date": date(2026, 1, 5)}, {"date": date(2026, 1, 30)}])
    assert [r.rule for r in V.order_alerts(rows, STREAMS["daily"]).collect()] == ["max_consecutive_missing_days"]
    timed = lambda *rows: bars(spark, *rows).withColumn("bar_time_utc", F.element_at(F.array(*[F.lit(r["bar_time_utc"]) for r in rows]), F.row_number().over(W.orderBy(F.monotonically_increasing_id()))))
    minute = [{"interval": "1m", "bar_time_utc": f"2026-01-05T15:{m:02d}:00Z", "volume": 0 if m < 3 else 5, "close": 100.0 if m < 25 else 900.0} for m in range(26)]
    assert {r.rule for r in V.order_alerts(timed(*minute), STREAMS["tick"]).collect()} == {"consecutive_zero_volume", "tick_price_spike"}
    assert {r.rule for r in V.order_alerts(timed(minute[0], minute[5]), STREAMS["intraday"]).collect()} == {"consistent_bar_spacing"}


def test_one_bad_fund_costs_that_fund_only(spark):
    good = lambda: spark.createDataFrame([("A", "a", "1%")], "symbol string, company_name string, weight_text string")

    def bad():
        raise ValueError("not a workbook")

    made, errors = etf.load_funds([(etf.EtfFile("SPY", "SP500", 0), good), (etf.EtfFile("QQQ", "NDX100", 1), bad)])
    assert [r.symbol for r in made.collect()] == ["A"] and errors == {"QQQ": "ValueError: not a workbook"}
    assert etf.load_funds([(etf.EtfFile("QQQ", "NDX100", 1), bad)])[0] is None


def test_a_bad_chunk_costs_that_chunk(spark, store):
    """A provider called for each chunk: one raises half way, one gives no JSON, one gives a bar of another day and symbol."""
    def gateway(symbol, day):
        from datetime import datetime, timezone

        t = int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp() * 1000)
        return {"symbol": symbol, "interval": "1d", "t": t, "o": 10.0, "h": 11.0, "l": 9.0, "c": 10.0, "v": 100.0}

    def get(symbol, start, end, interval):  # what it needs goes with it to the workers
        import json

        yield gateway(symbol, str(end))
        if symbol == "A" and start.month == 3:
            raise TimeoutError("gone")
        if symbol == "B" and start.day == 31:
            yield "<html>"
        if symbol == "C":
            yield from (json.dumps(gateway("D", str(end))), gateway("C", "2020-01-06"), "")
        if symbol == "E":
            raise OSError("down")

    who = tickers(spark, "A", "B", "C", "E")
    made = run_job(store, {"ibkr": get}, who, CFG, TODAY, "b1", start=date(2026, 1, 1), end=date(2026, 3, 31))
    rows = {r.symbol: r for r in made.report.collect()}
    assert {s: (r.landed, r.failed_chunks, r.status) for s, r in rows.items()} == {"A": (2, 1, "partial"), "B": (2, 1, "partial"), "C": (3, 0, "success"), "E": (0, 3, "failed")}
    assert rows["A"].error == "TimeoutError: gone" and rows["B"].error.startswith("ValueError: line 2")
    assert {(r.symbol, str(r.chunk_start)) for r in made.failed.collect()} >= {("A", "2026-03-02"), ("B", "2026-01-31")}
    total = made.summary.first()
    assert (total.total_symbols, total.failed_symbols, total.partial_symbols, total.success_rate_pct) == (4, 1, 2, 75.0)
    made.discard()


def test_summary_counts_failed_and_skipped(spark, store, tmp_path):
    """Four symbols: two failed, one without data; half of them is no whole."""
    failed = spark.createDataFrame([("A", "x"), ("B", "y")], "symbol string, error string")
    made = run_job(store, {"ibkr": landed(tmp_path, "a", gateway("D", "2026-06-17"))}, tickers(spark, "A", "B", "C", "D"), CFG, TODAY, "b1", failures=failed)
    total = made.summary.first()
    assert (total.total_symbols, total.successful_symbols, total.failed_symbols, total.skipped_symbols, total.success_rate_pct) == (4, 1, 2, 1, 50.0)


def test_counters_come_with_the_batch(spark, store):
    rows = bars(spark, {}, {"symbol": "B", "high": 1.0}, {"symbol": "C", "volume": 0}, {"symbol": "A", "date": date(2026, 1, 5)}, {"symbol": "A", "date": date(2026, 3, 2)})
    done = job.ingest_batch(store, rows, STREAMS["daily"], "b1", now=F.lit("2026-06-18").cast("timestamp"))
    c = done.counters
    assert (c["total_input"], c["total_passed"], c["total_flagged"], c["total_rejected"]) == (5, 3, 1, 1) and str(c["first_date"]) == "2026-01-05"
    assert {(r.rule, r.hits) for r in done.hits.collect()} >= {("high_gte_low", 1), ("volume_positive", 1)}
    assert {(r.symbol, r.rule) for r in done.alerts.collect()} == {("A", "max_consecutive_missing_days")}
    empty = job.ingest_batch(store, bars(spark, {}).limit(0), STREAMS["daily"], "b2")
    assert empty.counters["total_input"] == 0 and empty.by_symbol.count() == 0 and empty.hits.count() == 0
    done.discard()
    empty.discard()


def test_average_of_span_one(spark):
    from tidemark.operators.sequence import ema

    made = ema(bars(spark, *[{"date": date(2026, 1, d), "close": float(d)} for d in (5, 6, 7)]), 1)
    assert {r.close: r.ema_1 for r in made.collect()} == {5.0: 5.0, 6.0: 6.0, 7.0: 7.0}
