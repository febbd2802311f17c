"""Classification, versions, watermarks, the planner's truth table, the job from end to end."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.config import STREAMS, Config, deep_merge
from tidemark.operators import classify as K
from tidemark.operators import watermark as H
from tidemark.plans import planner as P
from tidemark.plans.job import batch_id, ingest, pipeline_version
from tidemark.store import TableStore
from test_rules import VALID, bars

TODAY = date(2026, 6, 22)


def test_new_amend_skip(spark):
    stored = bars(spark, {}, {"symbol": "B"}).withColumns({"record_version": F.lit(3), "batch_id": F.lit("b0")})
    incoming = bars(spark, {}, {"symbol": "B", "close": 152.0}, {"symbol": "C"}, {"symbol": "C"}, {"symbol": "B", "close": None})
    made = K.classify(incoming, stored)
    assert sorted((r.symbol, r.action) for r in made.collect()) == [("AAPL", "skip"), ("B", "amend"), ("B", "skip"), ("C", "new"), ("C", "new")]
    fixed = K.amend(made, "b1").first()
    assert (fixed.record_version, fixed.supersedes_batch, fixed.batch_id, fixed.is_amended) == (4, "b0", "b1", True)
    with pytest.raises(ValueError):
        K.amend(made, "b1", "whim")


def test_amend_fields_and_chain(spark):
    stored = S.conform(bars(spark, {}).withColumns({"record_version": F.lit(1), "batch_id": F.lit("b0")}), S.BARS_SCHEMA)
    key = bars(spark, {}).select("symbol", "date", "interval")
    second = K.amend_fields(stored, key.withColumn("close", F.lit(152.0)), "b1", "restatement")
    third = K.amend_fields(stored.unionByName(second), key.withColumns({"close": F.lit(152.5), "split_factor": F.lit(0.5)}), "b2", "split_adjustment")
    row = K.latest(stored.unionByName(second).unionByName(third)).first()
    assert (row.close, row.record_version, row.supersedes_batch, row.has_corporate_action) == (152.5, 3, "b1", True)
    with pytest.raises(ValueError):
        K.amend_fields(stored, key.withColumn("record_version", F.lit(9)), "b", "restatement")


def test_latest_ties(spark):
    rows = [("A", 1, "2026-01-01", "x"), ("A", 1, "2026-01-02", "w")]
    frame = spark.createDataFrame(rows, "symbol string, record_version int, ingested_at string, batch_id string").withColumns({"date": F.lit(TODAY), "interval": F.lit("1d")})
    assert K.latest(frame).first().batch_id == "w"


def test_watermarks(spark):
    old = spark.createDataFrame([(1, "daily", date(2020, 1, 1), date(2020, 2, 1), 5, "b0", "m", "active", 2, "t0", "t0"), (2, "daily", date(2020, 1, 1), date(2020, 2, 1), 5, "b0", "m", "active", 2, "t0", "t0")], S.WATERMARK_SCHEMA)
    new = [(1, "daily", date(2020, 1, 15), date(2020, 3, 1), 7, "b1", "INCREMENTAL", "failed"), (2, "daily", date(2019, 1, 1), date(2019, 3, 1), 7, "b1", "INCREMENTAL", "success"), (3, "tick", date(2020, 1, 1), date(2020, 1, 1), 1, "b1", "INITIAL_LOAD", "success")]
    frame = spark.createDataFrame(new, "instrument_id long, stream string, earliest_date date, latest_date date, record_count long, batch_id string, mode string, run_status string")
    made = {r.instrument_id: r for r in H.upsert(old, frame, now=F.lit("t1")).collect()}
    assert (made[1].earliest_date, made[1].latest_date, made[1].status, made[1].consecutive_failures, made[1].created_at) == (date(2020, 1, 1), date(2020, 3, 1), "suspended", 3, "t0")
    assert (made[2].earliest_date, made[2].latest_date, made[2].consecutive_failures) == (date(2019, 1, 1), date(2020, 2, 1), 0)
    assert made[3].created_at == "t1"
    assert H.find(frame, "tick").count() == 1


def plan(spark, latest, status="active", history=None, symbol="AAPL", **overrides):
    mark = (date(2016, 1, 4), latest, status) if latest else (None, None, None)
    frame = spark.createDataFrame([(symbol, history, *mark)], "symbol string, history_start date, wm_earliest date, wm_latest date, wm_status string")
    return P.plan(frame, P.PlanConfig(STREAMS["daily"], **overrides), F.lit(TODAY)).first()


def test_plan_modes(spark):
    fresh, stale = TODAY - timedelta(4), TODAY - timedelta(60)
    full = P.Override(True, (), date(2019, 6, 1), date(2019, 6, 30), True)
    row = plan(spark, fresh)
    assert (row["mode"], row.start_date, row.ingestion_type) == ("INCREMENTAL", fresh - timedelta(3), "scheduled")
    row = plan(spark, stale)
    assert (row["mode"], row.start_date, row.end_date) == ("GAP_FILL", stale + timedelta(1), TODAY)
    assert plan(spark, TODAY)["mode"] == "NO_OP"
    row = plan(spark, None)
    assert (row["mode"], row.start_date) == ("INITIAL_LOAD", date(2016, 6, 22)) and row.date_range_days > 3000
    assert plan(spark, None, history=date(2020, 5, 5)).start_date == date(2020, 5, 5)
    assert plan(spark, fresh, "suspended", force_reload=full)["mode"] == "NO_OP"
    assert plan(spark, fresh, force_reload=full, restatement=full)["mode"] == "FORCE_RELOAD"
    assert plan(spark, fresh, force_reload=P.Override(True))["mode"] == "INCREMENTAL"  # not confirmed
    row = plan(spark, fresh, restatement=full, date_range=full)
    assert (row["mode"], row.is_amendment_run, row.ingestion_type) == ("RESTATEMENT", True, "amendment")
    assert plan(spark, fresh, date_range=full)["mode"] == "EXPLICIT_DATE_RANGE"
    row = plan(spark, fresh, history_extension=P.Override(True, ("aapl",), date(2010, 1, 1)))
    assert (row["mode"], row.end_date) == ("HISTORY_EXTENSION", date(2016, 1, 3))
    assert plan(spark, fresh, history_extension=P.Override(True, ("MSFT",), date(2010, 1, 1)))["mode"] == "INCREMENTAL"
    assert plan(spark, fresh, history_extension=P.Override(True, (), date(2020, 1, 1)))["mode"] == "INCREMENTAL"


def test_chunks_and_override(spark):
    frame = spark.createDataFrame([("A", "GAP_FILL", date(2020, 1, 1), date(2020, 2, 15)), ("B", "NO_OP", TODAY, TODAY)], "symbol string, mode string, start_date date, end_date date")
    made = [(r.chunk_start, r.chunk_end) for r in P.chunks(frame, 30).orderBy("chunk").collect()]
    assert made == [(date(2020, 1, 1), date(2020, 1, 30)), (date(2020, 1, 31), date(2020, 2, 15))]
    assert P.override_dates(frame, date(2020, 5, 1), date(2020, 5, 3)).select("mode").distinct().first()[0] == "EXPLICIT_DATE_RANGE"
    assert P.override_dates(frame, date(2020, 5, 1), None) is frame


def test_job_twice_then_amended(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    ids = spark.createDataFrame([("AAPL", 1), ("B", 2)], "symbol string, instrument_id long")
    batch = bars(spark, {}, {"symbol": "B"}, {"symbol": "B", "date": date(2026, 6, 18), "high": 1.0})
    first = ingest(store, batch, STREAMS["daily"], "b1", "v1", ids).first()
    assert (first.written, first.amended, first.skipped, first.rejected) == (2, 0, 0, 1)
    again = ingest(store, batch, STREAMS["daily"], "b2", "v1", ids).first()
    assert (again.written, again.skipped) == (0, 2)
    third = ingest(store, bars(spark, {"close": 152.0}), STREAMS["daily"], "b3", "v1", ids).first()
    assert third.amended == 1
    table = store.read("market_data_daily", S.BARS_SCHEMA)
    row = K.latest(table).where("symbol = 'AAPL'").first()
    assert table.count() == 3 and (row.close, row.record_version, row.supersedes_batch) == (152.0, 2, "b1")
    assert store.read("market_data_rejected").count() == 2
    marks = {r.instrument_id: r for r in store.read("ingestion_watermark").collect()}
    assert marks[1].batch_id == "b3" and marks[2].batch_id == "b1"
    assert ingest(store, bars(spark, {"symbol": "Z"}), STREAMS["daily"], "b4", dry_run=True).first().written == 1
    assert store.read("market_data_daily").count() == 3
    assert batch_id("daily").startswith("batch_daily_")


def test_store_seed_and_replace(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.seed("t", spark.range(3)) and not store.seed("t", spark.range(5))
    store.replace("t", store.read("t").where("id > 0"))
    store.append("t", spark.range(9, 10))
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2, 9]
    with pytest.raises(FileNotFoundError):
        store.path("none")


def test_tables_and_version(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    assert set(store.create_all()) == set(S.TABLES) and store.create_all() == []
    assert store.read("ingestion_watermark").schema == S.WATERMARK_SCHEMA
    monkeypatch.setenv("PIPELINE_VERSION", "v9")
    assert pipeline_version() == "v9"


def test_config():
    merged = deep_merge({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2], "d": 3}})
    cfg = Config(merged)
    assert cfg.get("a.b") == 1 and cfg.get("a.c") == [2] and cfg.get("a.x", 7) == 7 and "a.d" in cfg and "z" not in cfg
    with pytest.raises(KeyError):
        cfg.require("a.none")


def test_invariants_and_tiers(spark):
    frame = bars(spark, {}, {"interval": "2h", "symbol": " "}, {"interval": "1h", "volume": None}).withColumns({"batch_id": F.lit("b"), "pipeline_version": F.lit("v")})
    found = [r.x for r in frame.select(S.broken_invariants(frame).alias("x")).collect()]
    assert found == [[], ["blank_symbol", "unknown_interval"], ["missing_bar_time", "not_numeric_volume"]]
    tiers = spark.createDataFrame([(i,) for i in S.INTERVALS], "i string").select(S.table_tier(F.col("i")).alias("t")).collect()
    assert [r.t for r in tiers] == ["daily", "intraday", "intraday", "intraday", "intraday", "tick"]
    with pytest.raises(Exception, match="unknown interval"):
        spark.createDataFrame([("9y",)], "i string").select(S.table_tier(F.col("i"))).collect()
    assert set(VALID) <= set(S.BARS_SCHEMA.names)
