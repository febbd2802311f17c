"""Landed provider payloads to bars, and what each provider can do."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.sequence import MINUTES
from tidemark.sources.chunks import Fetch, in_chunk

ISO_UTC, ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss"
NEW_YORK = "America/New_York"
# Bar codes of the gateway.
BAR_CODES = {"1d": "1d", "1h": "1h", "4h": "4h", "5m": "5mins", "1m": "1min"}
QUOTE_FIELDS = {"31": "last", "84": "bid", "86": "ask", "7762": "volume", "7295": "open", "70": "high", "71": "low"}


def period_code(days: Column) -> Column:
    """Days as the gateway's period: up to 30 days, up to 52 weeks, else months."""
    n = lambda c, unit: F.concat(F.greatest(F.lit(1), F.floor(c)).cast("string"), F.lit(unit))
    return F.when(days <= 30, F.concat(days.cast("string"), F.lit("d"))).when(days <= 365, n(days / 7, "w")).otherwise(n(days / 30, "m"))


def bar_code(interval: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in BAR_CODES.items() for x in kv]), interval)


def _minutes(interval: Column) -> Column:
    pairs = [F.lit(x) for k, v in MINUTES.items() for x in (k, v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), interval), F.lit(60))


def _times(stamp: Column, interval: Column) -> dict[str, Column]:
    """Bar times as ISO text; daily bars have none."""
    intraday = lambda c: F.when(interval != "1d", c)
    end = F.timestamp_seconds(F.unix_timestamp(stamp) + _minutes(interval) * 60)
    return {
        "bar_time_utc": intraday(F.date_format(stamp, ISO_UTC)),
        "bar_time_eastern": intraday(F.date_format(F.from_utc_timestamp(stamp, NEW_YORK), ISO_LOCAL)),
        "bar_end_time_utc": intraday(F.date_format(end, ISO_UTC)),
        "timezone_source": intraday(F.lit(NEW_YORK)),
    }


def map_gateway_bars(raw: DataFrame) -> DataFrame:
    """Bars of the gateway: symbol, interval, t (epoch ms), o, h, l, c, v.

    A bar without time, or whose open or close isn't positive, is dropped.
    The session time zone must be UTC.
    """
    stamp = F.timestamp_millis(F.col("t"))
    num = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    made = raw.where((F.coalesce(F.col("t"), F.lit(0)) != 0) & (num("o") > 0) & (num("c") > 0))
    made = made.select(
        "symbol", F.to_date(stamp).alias("date"), "interval", F.lit("ibkr").alias("source"), num("o").alias("open"), num("h").alias("high"), num("l").alias("low"), num("c").alias("close"),
        num("v").cast("long").alias("volume"), num("c").alias("adj_close"), F.lit(1.0).alias("adj_factor"), num("c").alias("unadj_close"), F.lit("SMART").alias("exchange"),
        *[c.alias(n) for n, c in _times(stamp, F.col("interval")).items()],
        F.lit(False).alias("has_corporate_action"), F.lit(0.0).alias("dividend_amount"), F.lit(False).alias("is_ex_dividend_date"), F.lit(False).alias("is_ex_split_date"),
        F.lit("client_portal_v1").alias("source_version"),
    )
    return _common(made)


def map_yahoo_rows(raw: DataFrame) -> DataFrame:
    """Rows of the price download: symbol, interval, ts, Open, High, Low, Close, Volume, Dividends, Stock Splits.

    A split of 4 becomes the factor 0.25; prices are adjusted already.
    """
    split, paid = F.coalesce(F.col("`Stock Splits`"), F.lit(0.0)), F.coalesce(F.col("Dividends"), F.lit(0.0))
    times = _times(F.col("ts").cast("timestamp"), F.col("interval"))
    times["bar_end_time_utc"] = F.lit(None).cast("string")
    made = raw.select(
        "symbol", F.to_date("ts").alias("date"), "interval", F.lit("yahoo").alias("source"), F.col("Open").alias("open"), F.col("High").alias("high"), F.col("Low").alias("low"), F.col("Close").alias("close"),
        F.col("Volume").cast("long").alias("volume"), F.col("Close").alias("adj_close"), F.col("Close").alias("unadj_close"), *[c.alias(n) for n, c in times.items()],
        ((paid != 0) | (split != 0)).alias("has_corporate_action"), F.when(split != 0, F.try_divide(F.lit(1.0), split)).alias("split_factor"), paid.alias("dividend_amount"),
        F.when(paid != 0, "cash").alias("dividend_type"), (paid != 0).alias("is_ex_dividend_date"), (split != 0).alias("is_ex_split_date"), F.lit("yfinance").alias("source_version"),
    )
    return _common(made)


def _common(df: DataFrame) -> DataFrame:
    out = df.withColumns({"currency": F.lit("USD"), "market_session": F.lit("regular"), "trading_halt": F.lit(False), "is_trading_day": F.lit(True)})
    return out.withColumns({f.name: F.lit(None).cast(f.dataType) for f in S.BARS_SCHEMA.fields if f.name not in out.columns}).select(*S.BARS_SCHEMA.names)


def latest_quotes(raw: DataFrame) -> DataFrame:
    """The last quote of each symbol; fields that aren't numbers, or not there, are null.

    ``raw``: symbol, ts, and fields as text under their codes or names.
    """
    fields = [F.coalesce(*[F.col(f"`{c}`") for c in (code, name) if c in raw.columns], F.lit(None).cast("string")).alias(name) for code, name in QUOTE_FIELDS.items()]
    num = lambda c: F.nullif(F.trim(c), F.lit("N/A")).try_cast("double").alias(c)
    last = F.max_by(F.struct("ts", *fields), "ts")
    return raw.groupBy("symbol").agg(last.alias("q")).select("symbol", "q.*").select("symbol", "ts", *map(num, QUOTE_FIELDS.values()))


def between_dates(bars: DataFrame, start: Column, end: Column) -> DataFrame:
    """Bars whose date lies in the range, both ends included."""
    return bars.where(F.col("date").between(start, end))


@dataclass(frozen=True)
class Provider:
    """A source of landed bars and what it can do."""

    name: str
    intervals: tuple[str, ...]
    options: bool
    realtime: bool
    mapper: Callable[[DataFrame], DataFrame]
    payload: str  # of one bar, as DDL
    day: str  # of a payload, as SQL


PROVIDERS = {
    "ibkr": Provider(
        "ibkr", ("1d", "1h", "4h", "5m", "1m"), True, True, map_gateway_bars,
        "symbol string, interval string, t long, o double, h double, l double, c double, v double", "to_date(timestamp_millis(t))",
    ),
    "yahoo": Provider(
        "yahoo", ("1d", "1h", "5m", "1m"), False, False, map_yahoo_rows,
        "symbol string, interval string, ts timestamp, Open double, High double, Low double, Close double, Volume double, Dividends double, `Stock Splits` double", "to_date(ts)",
    ),
}
PRIMARY, FALLBACK = "ibkr", "yahoo"


def provider(name: str | None = None) -> Provider:
    """A provider by name, the primary one without."""
    try:
        return PROVIDERS[name or PRIMARY]
    except KeyError:
        raise ValueError(f"unknown provider {name}; there are {sorted(PROVIDERS)}") from None


def capabilities(spark: SparkSession) -> DataFrame:
    rows = [(p.name, i, p.options, p.realtime) for p in PROVIDERS.values() for i in p.intervals]
    return spark.createDataFrame(rows, "provider string, interval string, options boolean, realtime boolean")


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads: JSON lines or Parquet, by the path's ending."""
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def healthy(spark: SparkSession, path: str | Fetch) -> bool:
    """Whether a landed source can be read and has rows; a fetcher says so itself, if it can."""
    if callable(path):
        return getattr(path, "healthy", lambda _: True)(spark)
    try:
        return not _landed(spark, path).isEmpty()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def choose(spark: SparkSession, landed: dict[str, str | Fetch]) -> str:
    """The primary provider if its landed source is healthy, else the fallback, for a whole run."""
    for name in (PRIMARY, FALLBACK):
        if name in landed and healthy(spark, landed[name]):
            return name
    raise RuntimeError("no provider has a readable source")


def read_bars(spark: SparkSession, path: str, name: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Landed payloads (JSON lines or Parquet, by the path's ending) as bars of a date range."""
    bars = provider(name).mapper(_landed(spark, path))
    return between_dates(bars, F.lit(start).cast("date"), F.lit(end).cast("date")) if start and end else bars


def chunk_bars(chunks: DataFrame, name: str | None = None) -> DataFrame:
    """Payloads of fetched chunks as bars; a bar of another symbol, interval or day than its chunk asked for is left out."""
    own = provider(name)
    asked = chunks.where("line is not null").select("symbol", "interval", "chunk_start", "chunk_end", F.from_json("line", own.payload).alias("p"))
    mine = (F.coalesce("p.symbol", "symbol") == F.col("symbol")) & (F.coalesce("p.interval", "interval") == F.col("interval"))
    fields = [F.col(f"p.`{f}`") for f in asked.schema["p"].dataType.names if f not in ("symbol", "interval")]
    rows = asked.where(mine).select("symbol", "interval", "chunk_start", "chunk_end", *fields)
    return own.mapper(rows.where(in_chunk(F.expr(own.day))).drop("chunk_start", "chunk_end"))
