"""The engine's tables derived from the test tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLIT_DAY, FIRST_INCOMING = "2001-01-01", "2000-12-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of 20 symbols from lineitem, with defects at fixed places.

    Open and close are the first and last line by a total order, taken by one
    hash aggregate; only ``prev_close`` needs a window.
    """
    px = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 20).alias("sid"), F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").alias("ep"), F.col("l_quantity").alias("qty"), (F.lit(100) + F.col("l_extendedprice") / 1000).alias("price"),
    )
    place = F.struct("l_orderkey", "l_linenumber", "ep", "qty", "price")
    worth = F.sum(F.col("ep").cast("decimal(18,2)") * F.col("qty").cast("decimal(4,0)")).cast("double")
    b = px.groupBy("sid", "date").agg(
        F.min(place)["price"].alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max(place)["price"].alias("close"), F.sum("qty").cast("long").alias("volume"),
        (F.lit(100) + worth / F.sum("qty") / 1000).alias("vwap"), F.count("*").alias("trade_count"),
    )
    k = F.col("sid") * 31 + F.date_diff("date", F.lit("1995-01-01").cast("date"))
    return b.select(
        F.concat(F.lit("S"), F.col("sid").cast("string")).alias("symbol"), "date", F.lit("1d").alias("interval"), F.lit("synthetic").alias("source"), "open",
        F.when(k % 97 == 0, F.col("low") - 1).otherwise(F.col("high")).alias("high"), "low",
        F.when(k % 83 != 0, F.col("close")).alias("close"), F.when(k % 89 == 0, 0).otherwise(F.col("volume")).alias("volume"),
        F.when(k % 79 == 0, F.col("high") * 2).otherwise(F.col("vwap")).alias("vwap"), "trade_count",
        F.lag("close").over(W.partitionBy("sid").orderBy("date")).alias("prev_close"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.upper("event_type").alias("symbol"), "ts", "value")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").withColumn("instrument_id", F.col("s_suppkey")).withColumn("symbol", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("instrument_id")
    return suppliers(spark, sf_dir).select("instrument_id", F.when(k % 5 == 0, "etf").otherwise("equity").alias("asset_class"), F.when(k % 4 != 0, F.concat(F.lit("FIGI"), k.cast("string"))).alias("figi"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suppliers(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = F.col("n_regionkey")
    mic = F.when(r == 0, "XNAS").when(r == 1, "XNYS").when(r == 2, "ARCX").when(r == 3, "XASE")
    now = s.join(nation, s.s_nationkey == nation.n_nationkey).select("instrument_id", "symbol", mic.alias("exchange_mic"), F.lit(True).alias("is_current"))
    old = s.where("instrument_id % 10 = 0").select("instrument_id", F.concat(F.lit("OLD"), F.col("instrument_id").cast("string")), F.lit("XNYS"), F.lit(False))
    return now.unionAll(old)


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suppliers(spark, sf_dir)
    row = lambda n, code: s.where(f"instrument_id % {n} = 0").select("instrument_id", F.lit(code).alias("universe_code"), F.lit(True).alias("is_active"))
    return row(2, "SP500").unionAll(row(3, "NDX100"))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("instrument_id")
    group = F.element_at(F.array(*map(F.lit, "ABCD")), (k % 4 + 1).cast("int"))
    return suppliers(spark, sf_dir).select("instrument_id", (k % 7 != 0).alias("is_active"), group.alias("batch_group"), (k % 5).cast("int").alias("priority"))


def stored_bars(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("date") < F.lit(SPLIT_DAY).cast("date")).withColumns({"record_version": F.lit(1), "batch_id": F.lit("b0")})


def incoming_bars(bars: DataFrame) -> DataFrame:
    later = bars.where(F.col("date") >= F.lit(FIRST_INCOMING).cast("date"))
    return later.withColumn("close", F.when(F.col("volume") % 10 == 0, F.col("close") + 0.5).otherwise(F.col("close")))


def watermarks(bars: DataFrame) -> DataFrame:
    """One row a symbol over the stored bars; the symbol's number is the instrument."""
    k = F.substring("symbol", 2, 9).cast("long")
    made = stored_bars(bars).groupBy(k.alias("instrument_id")).agg(F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"), F.count("*").alias("record_count"))
    failures = (F.col("instrument_id") % 6).cast("int")
    return made.select(
        "instrument_id", F.lit("daily").alias("stream"), "earliest_date", "latest_date", "record_count", F.lit("b0").alias("batch_id"), F.lit("INITIAL_LOAD").alias("mode"),
        F.when(failures >= 3, "suspended").otherwise("active").alias("status"), failures.alias("consecutive_failures"), F.lit("t0").alias("created_at"), F.lit("t0").alias("updated_at"),
    )


def nasdaq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, value) of the first directory file, one line a part."""
    return _lines(spark, sf_dir, ("symbol", "name", F.lit("Q"), "test", F.lit("N"), F.lit("100"), "etf", F.lit("N")))


def other_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, ("A", "N", "P", "Z", "V", "X"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return _lines(spark, sf_dir, ("symbol", "name", code, "symbol", "etf", F.lit("100"), "test", "symbol"))


def _lines(spark: SparkSession, sf_dir: str, fields: tuple) -> DataFrame:
    k = F.col("p_partkey")
    made = table(spark, sf_dir, "part").withColumns({
        "symbol": F.concat(F.lit("P"), k.cast("string"), F.when(k % 50 == 0, "$").otherwise("")),
        "name": F.concat("p_name", F.when(k % 11 == 0, " Warrant").when(k % 13 == 0, " Units").otherwise("")),
        "test": F.when(k % 17 == 0, "Y").otherwise("N"),
        "etf": F.when(F.col("p_size") > 40, "Y").otherwise("N"),
    })
    return made.select(k.alias("line_no"), F.concat_ws("|", *fields).alias("value"))


RUN_START, RUN_END = "1999-01-01", "1999-12-31"


def chunk_lines(bars: DataFrame, requests: DataFrame, repaired: bool = False) -> DataFrame:
    """Gateway payloads of daily bars by requested chunk, with faults unless ``repaired``: chunks that break off, and some that don't land.

    S7 has no whole chunk, S8 only bars that the mapper drops. Repaired chunks
    have every tenth close raised.
    """
    sid, chunk = F.substring("symbol", 2, 9).cast("int"), F.floor(F.date_diff("date", F.lit(RUN_START).cast("date")) / 30).cast("int")
    close = F.when(F.col("volume") % 10 == 0, F.col("close") + 0.5).otherwise(F.col("close")) if repaired else F.col("close")
    payload = F.to_json(F.struct("symbol", "interval", F.unix_millis(F.col("date").cast("timestamp")).alias("t"), F.when(sid == 8, 0.0).otherwise(F.col("open")).alias("o"),
                                 F.col("high").alias("h"), F.col("low").alias("l"), close.alias("c"), F.col("volume").alias("v")))
    rows = bars.where(F.col("date").between(RUN_START, RUN_END)).select("symbol", chunk.alias("chunk"), payload.alias("line"))
    each = requests.select("symbol", F.lit("1d").alias("interval"), "chunk", "chunk_start")
    lines = each.join(rows, ["symbol", "chunk"], "left").select("symbol", "interval", "chunk", "chunk_start", "line")
    if repaired:
        return lines
    cut = each.where((sid == 7) | ((sid + F.col("chunk")) % 7 == 0)).withColumn("line", F.lit('{"symbol": '))
    return lines.unionByName(cut).where((sid + F.col("chunk")) % 11 != 3)
