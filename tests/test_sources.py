"""Listings, funds, providers, universe, calendar, streaming."""

import io
import zipfile
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as C
from tidemark.operators import control as O
from tidemark.operators import sequence as Q
from tidemark.operators import universe as U
from tidemark.sources import etf, files, listings, providers
from tidemark.streaming.bars import bars_from_ticks

NASDAQ = "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares\nAAPL|Apple Inc.|Q|N|N|100|N|N\nQQQ|Invesco Trust|G|N|N|100|Y|N\nZZZ|Some Unit Trust|Q|N|N|100|N|N\nTST|Test Co|Q|Y|N|100|N|N\nX$|X|Q|N|N|100|N|N\nshort|line\nAAPL|Apple Again|Q|N|N|100|N|N\nFile Creation Time: 0622202612:00|||||||\n"
OTHER = "ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol\nIBM|IBM Corp|N|IBM|N|100|N|IBM\nSPY|SPDR|P|SPY|Y|100|N|SPY\nAAPL|Late|N|AAPL|N|100|N|AAPL\nODD|Odd|?|ODD|N|100|N|ODD\n"


def test_listings(spark, tmp_path):
    (tmp_path / "a.txt").write_text(NASDAQ)
    (tmp_path / "b.txt").write_text(OTHER)
    a = listings.parse_nasdaq(listings.read_lines(spark, str(tmp_path / "a.txt")))
    b = listings.parse_other(listings.read_lines(spark, str(tmp_path / "b.txt")))
    assert sorted(r.symbol for r in a.collect()) == ["AAPL", "AAPL", "QQQ"]
    made = {r.symbol: r for r in listings.merge(a, b).collect()}
    assert set(made) == {"AAPL", "QQQ", "IBM", "SPY", "ODD"}
    assert made["AAPL"].company_name == "Apple Again" and made["SPY"].exchange_mic == "ARCX" and made["ODD"].exchange_mic is None and made["QQQ"].asset_class == "etf"


def test_etf_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text('Fund\n\nTicker,Name,Weight\n aapl ,"Apple, Inc.",6.5%\nCASH,Cash,1%\n-,x,1%\nMSFT,Microsoft,n/a\n')
    cfg = etf.EtfFile("SPY", "SP500", 0, skip_rows=2)
    made = {r.symbol: r for r in etf.normalise(etf.parse_csv(spark, str(tmp_path / "h.csv"), cfg)).collect()}
    assert set(made) == {"AAPL", "MSFT"} and made["AAPL"].weight == pytest.approx(0.065) and made["AAPL"].company_name == "Apple, Inc." and made["MSFT"].weight is None
    data = io.BytesIO()
    row = lambda n, *v: f'<row r="{n}">' + "".join(f'<c r="{"ABC"[i]}{n}" t="inlineStr"><is><t>{x}</t></is></c>' for i, x in enumerate(v)) + "</row>"
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + row(1, "Ticker", "Name", "Weight") + row(2, "nvda", "Nvidia", "5") + "</sheetData></worksheet>")
    sheet = etf.normalise(etf.parse_xlsx(spark, data.getvalue(), etf.EtfFile("QQQ", "NDX100", 1)))
    assert [(r.symbol, r.weight) for r in sheet.collect()] == [("NVDA", 0.05)]


def test_etf_merge(spark):
    rows = [("A", "a", 0.1, "SP500", 0), ("A", "b", 0.2, "NDX100", 1), ("B", "c", None, "R2K", 2)]
    made = {r.symbol: r for r in etf.merge(spark.createDataFrame(rows, "symbol string, company_name string, weight double, universe_code string, etf_order int")).collect()}
    assert made["A"].universe_codes == ["SP500", "NDX100"] and made["A"].weight == 0.1 and made["A"].is_active and not made["B"].is_active


def test_gateway_bars(spark):
    t = int(datetime(2026, 6, 22, 14, 30, tzinfo=timezone.utc).timestamp() * 1000)
    rows = [("A", "1h", t, 1.0, 2.0, 0.5, 1.5, 10.9), ("A", "1d", t, 1.0, 2.0, 0.5, 1.5, 10.0), ("B", "1d", 0, 1.0, 1.0, 1.0, 1.0, 1.0), ("C", "1d", t, 0.0, 1.0, 1.0, 1.0, 1.0)]
    made = providers.map_gateway_bars(spark.createDataFrame(rows, "symbol string, interval string, t long, o double, h double, l double, c double, v double")).collect()
    hour = next(r for r in made if r.interval == "1h")
    assert len(made) == 2 and (hour.bar_time_utc, hour.bar_time_eastern, hour.bar_end_time_utc, hour.volume) == ("2026-06-22T14:30:00Z", "2026-06-22T10:30:00", "2026-06-22T15:30:00Z", 10)
    assert next(r for r in made if r.interval == "1d").bar_time_utc is None


def test_yahoo_rows(spark):
    rows = [("A", "1d", datetime(2026, 6, 22), 1.0, 2.0, 0.5, 1.5, 10, 0.75, 0.0), ("A", "1d", datetime(2026, 6, 23), 1.0, 2.0, 0.5, 1.5, 10, 0.0, 4.0)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, ts timestamp, Open double, High double, Low double, Close double, Volume long, Dividends double, `Stock Splits` double")
    paid, split = providers.map_yahoo_rows(frame).orderBy("date").collect()
    assert (paid.dividend_amount, paid.dividend_type, paid.split_factor) == (0.75, "cash", None) and (split.split_factor, split.is_ex_split_date, split.has_corporate_action) == (0.25, True, True)


def test_providers(spark, tmp_path):
    assert providers.provider().name == "ibkr" and providers.provider("yahoo").options is False
    with pytest.raises(ValueError):
        providers.provider("none")
    assert not providers.healthy(spark, str(tmp_path / "none"))
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert providers.healthy(spark, str(tmp_path / "some"))
    assert providers.choose(spark, {"ibkr": str(tmp_path / "none"), "yahoo": str(tmp_path / "some")}) == "yahoo"
    with pytest.raises(RuntimeError):
        providers.choose(spark, {"ibkr": str(tmp_path / "none")})
    codes = spark.createDataFrame([(30,), (31,), (365,), (366,)], "d int").select(providers.period_code(F.col("d")).alias("p")).collect()
    assert [r.p for r in codes] == ["30d", "4w", "52w", "12m"]


def test_tickers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("symbol,name,sector,asset_class,active,added_date,min_price,market_cap_tier,history_start,ipo_date,notes\naapl,Apple,Tech,equity,true,2026-01-01,5.0,mega,,1980-12-12,x\nbad,Bad,Tech,equity,false,2026-13-01,abc,,2020-01-01,,\n,None,,,,,,,,,\n")
    t = files.read_tickers(spark, str(tmp_path / "t.csv"))
    rows = {r.symbol: r for r in t.withColumn("start", U.effective_history_start(t)).collect()}
    assert set(rows) == {"AAPL", "BAD"} and rows["AAPL"].start == date(1980, 12, 12) and rows["BAD"].min_price is None and rows["BAD"].added_date is None
    assert [r.symbol for r in U.select_tickers(t, symbols=("AAPL", "bad")).collect()] == ["AAPL"]
    (tmp_path / "s.csv").write_text('name,entry_indicators\nswing,"ema15, ema45"\n')
    assert files.read_strategies(spark, str(tmp_path / "s.csv")).first().entry_indicators == ["ema15", "ema45"]
    path = files.land_text(spark.createDataFrame([("a",), ("b",)], "value string"), str(tmp_path), "nasdaq", "2026-01-01")
    assert spark.read.text(path).count() == 2
    path = files.land_bytes(spark, b"\x00\xffPK", str(tmp_path), "etf", "2026-01-01", "a.xlsx")
    assert bytes(spark.read.format("binaryFile").load(path).first().content) == b"\x00\xffPK"


def test_calendar(spark):
    day = lambda d: spark.range(1).select(C.is_trading_day(F.lit(d).cast("date")).alias("a"), C.last_trading_day(F.lit(d).cast("date")).alias("b")).first()
    assert day("2026-07-04") == (False, date(2026, 7, 2)) and day("2026-07-06") == (True, date(2026, 7, 6)) and not day("2025-01-09").a and day("2021-12-31").a
    assert [r.date.day for r in C.trading_days_between(spark, "2026-07-01", "2026-07-07").collect()] == [1, 2, 6, 7]
    assert C.trading_days_between(spark, "2026-07-07", "2026-07-01").count() == 0
    assert len(C.holidays()) == 279 and date(2040, 4, 30) in C.holidays()
    opened = spark.createDataFrame([(datetime(2026, 6, 22, 13, 29),), (datetime(2026, 6, 22, 13, 30),), (datetime(2026, 6, 22, 19, 59),), (datetime(2026, 6, 22, 20, 0),), (datetime(2026, 6, 20, 15, 0),)], "t timestamp").select(C.is_market_open(F.col("t")).alias("o")).collect()
    assert [r.o for r in opened] == [False, True, True, False, False]


def test_sequences(spark):
    rows = [("A", "1d", date(2026, 1, d), 0 if 3 <= d <= 6 else 5, 100.0) for d in range(1, 11)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, date date, volume long, close double")
    run = Q.zero_volume_runs(frame).first()
    assert (run.run_start, run.run_end, run.n_bars) == (date(2026, 1, 3), date(2026, 1, 6), 4)
    prices = [("A", "1m", i, 100.0 + i % 2) for i in range(25)] + [("A", "1m", 25, 150.0)]
    spike = Q.price_spikes(spark.createDataFrame(prices, "symbol string, interval string, n int, close double"), order="n").collect()
    assert [(r.n, r.close) for r in spike] == [(25, 150.0)]
    smooth = Q.ema(frame, 5).orderBy("date").collect()
    assert smooth[-1].ema_5 == pytest.approx(100.0)


def test_averages_over_whole_series(spark):
    """A series of several blocks, against the plain recurrence; a second symbol and a null stay apart."""
    values = [100 + 30 * ((i * 37) % 101) / 101 for i in range(3 * Q.BLOCK + 5)]
    rows = [("A", "1m", i, v) for i, v in enumerate(values)] + [("B", "1m", 0, None), ("B", "1m", 1, 7.0), ("B", "1m", 2, 9.0)]
    made = Q.ema(spark.createDataFrame(rows, "symbol string, interval string, n int, close double"), 9, time="n").orderBy("symbol", "n").collect()
    want, state = [], values[0]
    for v in values:
        state += (v - state) * 0.2
        want.append(state)
    assert [r.ema_9 for r in made] == pytest.approx([*want, 7.0, 7.4], abs=1e-9)
    empty = Q.trend(spark.createDataFrame([], "symbol string, interval string, date date, high double, low double, close double"))
    assert empty.collect() == []


def test_con_id_cache(spark):
    names = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), ("D",), (None,)], "symbol string")
    cache = spark.createDataFrame([("A", 1), ("D", None)], "symbol string, con_id long")
    contracts = spark.createDataFrame([("A", 0, 9), ("B", 0, None), ("B", 1, 2), ("B", 2, 3), ("D", 0, 4)], "symbol string, pos int, con_id long")
    made = sorted(tuple(r) for r in U.resolve_con_ids(names, cache, contracts).collect())
    assert made == [("A", 1, "cached"), ("B", 2, "found"), ("C", None, "missing"), ("D", 4, "found")]


def test_universe_dml(spark):
    listing = spark.createDataFrame([(1, "A", "XNAS", date(2020, 1, 1), None, True), (2, "B", None, date(2020, 1, 1), None, True)], "instrument_id long, symbol string, exchange_mic string, valid_from date, valid_to date, is_current boolean")
    made = U.rename_listing(listing, spark.createDataFrame([("A", "AA")], "old_symbol string, new_symbol string"), F.lit(date(2026, 1, 1)))
    assert sorted((r.symbol, r.is_current, r.valid_to) for r in made.collect() if r.instrument_id == 1) == [("A", False, date(2026, 1, 1)), ("AA", True, None)]
    found = U.recover_ids(spark.createDataFrame([("B", None), ("A", "XNYS")], "symbol string, exchange_mic string"), listing)
    assert {r.symbol: r.instrument_id for r in found.collect()} == {"B": 2, "A": None}
    ids = U.assign_ids(listing.select("symbol"), "id", ("symbol",), 10)
    assert sorted((r.symbol, r.id) for r in ids.collect()) == [("A", 11), ("B", 12)]
    checks = {r.constraint_name: r.violations for r in O.violations(listing, ("symbol", "exchange_mic"), ("symbol",)).collect()}
    assert checks == {"not_null_symbol": 0, "not_null_exchange_mic": 1, "unique_symbol": 0}


def test_stream_of_ticks(spark, tmp_path):
    at = lambda h, m: datetime(2026, 1, 5, h, m)
    rows = [("A", at(9, 0), 1.0), ("A", at(9, 30), 3.0), ("A", at(9, 59), 2.0), ("A", at(10, 1), 5.0), ("A", at(23, 0), 9.0)]
    schema = "symbol string, ts timestamp, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    bars = bars_from_ticks(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    run = bars.writeStream.format("memory").queryName("stream_bars").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    streamed = {r.bar_time.hour: (r.open, r.high, r.low, r.close, r.volume) for r in spark.table("stream_bars").collect()}
    batch = {r.bar_time.hour: (r.open, r.high, r.low, r.close, r.volume) for r in bars_from_ticks(spark.read.parquet(str(tmp_path / "in"))).collect()}
    assert batch[9] == (1.0, 3.0, 1.0, 2.0, 3) and streamed.items() <= batch.items() and 9 in streamed


def test_stream_ingestion(spark, tmp_path):
    from tidemark import schemas as S
    from tidemark.config import STREAMS
    from tidemark.store import TableStore
    from tidemark.streaming.bars import ingest_stream
    from test_rules import bars

    S.conform(bars(spark, {}, {"symbol": "B"}), S.BARS_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    store = TableStore(spark, str(tmp_path / "tables"))
    ingest_stream(spark.readStream.schema(S.BARS_SCHEMA).parquet(str(tmp_path / "in")), store, STREAMS["daily"], str(tmp_path / "cp")).awaitTermination()
    assert store.read("market_data_daily").count() == 2
