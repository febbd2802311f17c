"""Tables kept up to date: silver by month, listings as of a day, rejects judged again, chunks as landed."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.config import STREAMS
from tidemark.operators import constraints as G
from tidemark.operators import universe as U
from tidemark.operators import validate as V
from tidemark.plans import job
from tidemark.sources import chunks as N
from tidemark.store import TableStore
from dataclasses import replace
from test_history import bars


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def files(store, name):
    return {r.file_path: r.file_modification_time for r in store.read(name).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def test_silver_leaves_other_months(spark, store):
    job.ingest(store, bars(spark, *[{"date": date(2026, m, 5)} for m in (1, 2, 3)]), STREAMS["daily"], "b1")
    months = [("1d", f"2026-0{m}") for m in (1, 2, 3)]
    job.refresh_silver(store, "market_data_daily", "silver", months)
    before = files(store, "silver")
    done = job.ingest_batch(store, bars(spark, {"date": date(2026, 2, 5), "close": 152.0}, {"date": date(2026, 2, 6)}), STREAMS["daily"], "b2")
    assert done.months == [("1d", "2026-02")]
    for _ in range(2):  # again, as after a death
        job.refresh_silver(store, "market_data_daily", "silver", done.months)
        after = files(store, "silver")
        assert {f: t for f, t in before.items() if "2026-02" not in f} == {f: t for f, t in after.items() if "2026-02" not in f}
        rows = {(r.date, r.record_version, r.close) for r in store.read("silver").collect()}
        assert {(str(d), v) for d, v, _ in rows} == {("2026-01-05", 1), ("2026-02-05", 2), ("2026-02-06", 1), ("2026-03-05", 1)} and len(rows) == 4


def test_as_of(spark):
    listing = spark.createDataFrame(
        [(1, "OLD", "X", None, date(2026, 2, 1)), (1, "NEW", "Y", date(2026, 2, 1), None), (2, "A", "X", date(2025, 6, 1), date(2025, 7, 1)), (2, "B", "X", date(2025, 6, 15), None), (3, "C", "X", date(2027, 1, 1), None)],
        "instrument_id long, symbol string, exchange_mic string, valid_from date, valid_to date",
    )
    rows = [(1, date(2024, 1, 1), "OLD"), (1, date(2026, 1, 31), "OLD"), (1, date(2026, 2, 1), "NEW"), (2, date(2025, 5, 31), None), (2, date(2025, 6, 14), "A"), (2, date(2025, 6, 15), "B"), (3, date(2026, 1, 1), None), (9, date(2026, 1, 1), None), (None, date(2026, 1, 1), None), (1, None, None)]
    made = U.as_of(spark.createDataFrame(rows, "instrument_id long, date date, want string"), listing)
    assert made.count() == len(rows) and all(r.symbol == r.want for r in made.collect())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert U.as_of(spark.createDataFrame([], "instrument_id long, date date"), listing).count() == 0


def test_rejects_are_judged_again_once(spark, store):
    rows = bars(spark, {"symbol": "A", "high": 1.0}, {"symbol": "B", "vwap": 1e6}, {"symbol": "B", "vwap": 1e6}, {"symbol": "C"})
    job.ingest(store, rows, STREAMS["daily"], "b1")
    assert store.read("market_data_rejected").count() == 3
    loose = replace(STREAMS["daily"], additional_rules=(), disabled_rules=("vwap_between_low_and_high",))
    first = job.reprocess_rejects(store, loose, "b2").first()
    again = job.reprocess_rejects(store, loose, "b3").first()
    assert first.written >= 1 and again.written == 0
    state = {(r.symbol, r.reprocessed, r.reprocessed_batch) for r in store.read("market_data_rejected", S.REJECT_SCHEMA).where("batch_id = 'b1'").collect()}
    assert state == {("A", False, None), ("B", True, "b2")}
    assert {r.symbol for r in store.read("market_data_daily").collect()} == {"B", "C"}


def test_compact_holds_no_bars(spark):
    made = V.compact(V.validate(bars(spark, {"symbol": "A", "high": 1.0}, {"symbol": "B"})))
    texts = {r.symbol: r.summary for r in made.collect()}
    assert '"high_gte_low":1' in texts["A"] and '"rule_hits":{}' in texts["B"] and "150" not in texts["B"]


def test_landed_chunks(spark, tmp_path):
    root = str(tmp_path / "chunks")
    rows = [("A/B", "1d", date(2026, 1, 1), '{"symbol": "A/B"}'), ("A/B", "1d", date(2026, 1, 1), '{"symbol": "A/B", "t": 1}'), ("C", "1d", date(2026, 1, 1), None)]
    N.land(spark.createDataFrame(rows, "symbol string, interval string, chunk_start date, line string"), root)
    asked = spark.createDataFrame([("A/B", 0, date(2026, 1, 1), date(2026, 1, 30)), ("C", 0, date(2026, 1, 1), date(2026, 1, 30)), ("D", 0, date(2026, 1, 1), date(2026, 1, 30))], "symbol string, chunk int, chunk_start date, chunk_end date")
    for where in (root, f"file://{root}", f"file:{root}"):
        made = N.fetch_chunks(asked, N.ChunkFiles(where)).collect()
        assert sorted((r.symbol, r.line is not None, r.error) for r in made) == [("A/B", True, None), ("A/B", True, None), ("D", False, "FileNotFoundError: no chunk of D at 2026-01-01")]
    assert N.fetch_chunks(asked, N.ChunkFiles(root, missing_ok=True)).where("error is not null").count() == 0
    assert N.ChunkFiles(root).healthy(spark) and not N.ChunkFiles(root + "x").healthy(spark)


def test_a_violating_append_stores_nothing(spark, store):
    store.create_all()
    assert G.insert(store, "instrument", spark.createDataFrame([("equity", "A Co"), ("etf", "B Fund")], "asset_class string, company_name string"), ("company_name",)) == 2
    assert {(r.instrument_id, r.company_name) for r in store.read("instrument").collect()} == {(1, "A Co"), (2, "B Fund")}
    row = "instrument_id long, symbol string, valid_from date"
    day = date(2026, 1, 1)
    assert G.insert(store, "instrument_listing", spark.createDataFrame([(1, "A", day), (2, "B", day)], row), ("symbol",)) == 2
    assert {(r.listing_id, r.symbol, r.currency, r.is_current) for r in store.read("instrument_listing").collect()} == {(1, "A", "USD", True), (2, "B", "USD", True)}
    with pytest.raises(G.ConstraintError, match="foreign_instrument_id.*not_null_symbol") as e:
        G.insert(store, "instrument_listing", spark.createDataFrame([(9, "X", day), (1, None, day), (1, "C", day)], row), ("symbol",))
    assert "'symbol': 'X'" in str(e.value) and "'symbol': 'C'" not in str(e.value)
    assert store.read("instrument_listing").count() == 2
    G.insert(store, "instrument_listing", spark.createDataFrame([(1, "C", day)], row), ("symbol",))
    assert {r.listing_id for r in store.read("instrument_listing").collect()} == {1, 2, 3}
    feed = spark.createDataFrame([(1,), (1,)], "instrument_id long")
    with pytest.raises(G.ConstraintError, match="unique_instrument_id_stream"):
        G.insert(store, "ticker_feed_config", feed, ("instrument_id",))
    assert G.insert(store, "ticker_feed_config", feed.limit(1), ("instrument_id",)) == 1
    with pytest.raises(G.ConstraintError, match="unique_instrument_id_stream"):
        G.insert(store, "ticker_feed_config", feed.limit(1), ("instrument_id",))
    assert [(r.stream, r.batch_group, r.priority) for r in store.read("ticker_feed_config").collect()] == [("daily", "A", 5)]


def test_change_feed_in_any_cut(spark, store, tmp_path):
    """One file at a time, all at once by a late start, and a replay after the first batch was lost: the same tables."""
    from tidemark.streaming.bars import change_counts, follow

    job.ingest(store, bars(spark, *[{"date": date(2026, m, 5)} for m in (1, 2, 3)]), STREAMS["daily"], "b1")
    follow(store, "market_data_daily", "slow", "slow_counts", str(tmp_path / "c1"), files=1).awaitTermination()
    job.ingest(store, bars(spark, {"date": date(2026, 2, 5), "close": 152.0}, {"date": date(2026, 2, 6)}), STREAMS["daily"], "b2")
    follow(store, "market_data_daily", "slow", "slow_counts", str(tmp_path / "c1"), files=1).awaitTermination()
    follow(store, "market_data_daily", "late", "late_counts", str(tmp_path / "c2")).awaitTermination()
    (tmp_path / "c2" / "commits" / "0").unlink()  # as if the batch had died after its writes
    (tmp_path / "c2" / "commits" / ".0.crc").unlink(missing_ok=True)
    follow(store, "market_data_daily", "late", "late_counts", str(tmp_path / "c2")).awaitTermination()
    want = {(r.date, r.record_version, r.close) for r in job.K.latest(job.stored_bars(store, "market_data_daily")).collect()}
    for silver, counts in (("slow", "slow_counts"), ("late", "late_counts")):
        assert {(r.date, r.record_version, r.close) for r in store.read(silver).collect()} == want
        assert {(r.batch_id, r.n_bars) for r in change_counts(store, counts).collect()} == {("b1", 3), ("b2", 2)}
    assert len(want) == 4


@pytest.mark.parametrize("share", [0.999, 0.5, 2 / 16, 0.001])
def test_averages_over_long_series(spark, share):
    """Against a plain loop, over more bars than a block, and than a block of blocks, has."""
    from tidemark.operators import sequence as Q

    n, old = 40_000, Q.BLOCK
    values = [float((i * 7919) % 101) for i in range(n)]
    df = spark.range(n).select(F.lit("A").alias("symbol"), F.lit("1m").alias("interval"), F.col("id").alias("date"), F.pmod(F.col("id") * 7919, F.lit(101)).cast("double").alias("close"))
    try:
        Q.BLOCK = 16 if share < 0.9 else old
        made = {r.date: r.x for r in Q.smoothed(df, {"x": ("close", share)}).collect()}
    finally:
        Q.BLOCK = old
    average = values[0]
    for i, v in enumerate(values):
        average = average + share * (v - average) if i else v
        assert abs(made[i] - average) < 1e-8
