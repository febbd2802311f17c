"""Schemas, enum domains and keys of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**columns: str) -> T.StructType:
    """Nullable columns by name, with Spark's names of their types."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


BARS_SCHEMA = _struct(
    symbol="string", date="date", interval="string", source="string", batch_id="string", pipeline_version="string", open="double", high="double",
    low="double", close="double", volume="bigint", adj_close="double", adj_factor="double", unadj_close="double", exchange="string",
    currency="string", market_session="string", trade_count="bigint", vwap="double", prev_close="double", session_open="double",
    session_close="double", pre_market_high="double", pre_market_low="double", pre_market_close="double", pre_market_volume="bigint",
    post_market_high="double", post_market_low="double", post_market_close="double", post_market_volume="bigint", bar_time_utc="string",
    bar_time_eastern="string", bar_end_time_utc="string", timezone_source="string", has_corporate_action="boolean", split_factor="double",
    dividend_amount="double", dividend_type="string", is_ex_dividend_date="boolean", is_ex_split_date="boolean", trading_halt="boolean",
    halt_reason="string", is_trading_day="boolean", shares_outstanding="bigint", market_cap_at_date="double", data_quality_flag="boolean",
    data_quality_reasons="string", is_amended="boolean", amendment_reason="string", supersedes_batch="string", data_completeness_pct="double",
    record_version="int", ingested_at="string", ingested_by="string", fetch_attempt_count="int", fetch_duration_ms="bigint", data_as_of="string",
    ingestion_type="string", source_version="string",
)
REJECT_SCHEMA = _struct(
    symbol="string", date="string", interval="string", source="string", batch_id="string", rejected_rule="string", rejection_reason="string",
    raw_record="string", rejected_at="string", raw_open="double", raw_high="double", raw_low="double", raw_close="double", raw_volume="bigint",
    reprocessed="boolean", reprocessed_at="string", reprocessed_batch="string", pipeline_version="string",
)
WATERMARK_SCHEMA = _struct(
    instrument_id="bigint", stream="string", earliest_date="date", latest_date="date", record_count="bigint", batch_id="string", mode="string",
    status="string", consecutive_failures="int", created_at="string", updated_at="string",
)
INSTRUMENT_SCHEMA = _struct(
    instrument_id="bigint", isin="string", figi="string", company_name="string", asset_class="string", source="string", created_at="string",
)
LISTING_SCHEMA = _struct(
    listing_id="bigint", instrument_id="bigint", symbol="string", exchange_mic="string", currency="string", con_id="bigint", min_lot_size="int",
    valid_from="date", valid_to="date", is_current="boolean",
)
MEMBERSHIP_SCHEMA = _struct(
    membership_id="bigint", instrument_id="bigint", universe_code="string", weight="double", is_active="boolean", added_date="date",
    removed_date="date",
)
FEED_SCHEMA = _struct(
    feed_id="bigint", instrument_id="bigint", stream="string", source="string", is_active="boolean", batch_group="string", priority="int",
    history_start="date", added_date="date",
)
CALENDAR_SCHEMA = _struct(
    exchange_mic="string", date="date", is_trading_day="boolean", open_time="string", close_time="string", holiday_name="string",
)
BATCH_CONFIG_SCHEMA = _struct(
    batch_group="string", stream="string", job_type="string", groups="string", max_symbols_per_run="int", is_active="boolean",
)
COMMAND_SCHEMA = _struct(
    command_id="bigint", instrument_id="bigint", symbol="string", command="string", start_date="date", end_date="date", status="string",
    requested_at="string", consumed_at="string",
)
RUN_LOG_SCHEMA = _struct(
    run_id="string", instrument_id="bigint", stream="string", status="string", records_written="bigint", error="string", started_at="string",
    completed_at="string",
)
TICKER_SCHEMA = _struct(
    symbol="string", name="string", sector="string", asset_class="string", active="string", added_date="string", min_price="string",
    market_cap_tier="string", history_start="string", ipo_date="string", notes="string",
)

TABLES = {
    "instrument": INSTRUMENT_SCHEMA, "instrument_listing": LISTING_SCHEMA, "universe_membership": MEMBERSHIP_SCHEMA, "ticker_feed_config": FEED_SCHEMA, "market_calendar": CALENDAR_SCHEMA,
    "ingestion_watermark": WATERMARK_SCHEMA, "ingestion_batch_config": BATCH_CONFIG_SCHEMA, "ingestion_command": COMMAND_SCHEMA, "job_run_log": RUN_LOG_SCHEMA,
}

# Members of the enums.
INTERVALS = ("1d", "1h", "4h", "15m", "5m", "1m")
SESSIONS = ("regular", "pre", "post", "extended")
INGESTION_TYPES = ("scheduled", "backfill", "amendment", "manual")
DIVIDEND_TYPES = ("cash", "special", "stock")
HALT_REASONS = ("news", "volatility", "regulatory", "circuit_breaker")
AMENDMENT_REASONS = ("provider_correction", "restatement", "split_adjustment", "dividend_adjustment")
# What an amendment may change.
AMENDABLE = (
    "open", "high", "low", "close", "volume", "adj_close", "adj_factor", "unadj_close", "vwap", "prev_close", "trade_count",
    "pre_market_high", "pre_market_low", "pre_market_close", "pre_market_volume", "post_market_high", "post_market_low", "post_market_close", "post_market_volume",
    "split_factor", "dividend_amount", "dividend_type", "is_ex_dividend_date", "is_ex_split_date", "trading_halt", "halt_reason", "shares_outstanding", "market_cap_at_date",
)
KEY = ("symbol", "date", "interval", "bar_time_utc")


def field(df: DataFrame, name: str) -> Column:
    """A bar column, or a null of its type where the frame doesn't carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(BARS_SCHEMA[name].dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a target schema: what doesn't parse becomes null, dates read their first ten characters."""
    have = dict(df.dtypes)

    def cast(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType) and have[f.name] == "string":
            iso = F.substring(c, 1, 10)
            return F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso.try_cast("date")).alias(f.name)
        if isinstance(f.dataType, (T.LongType, T.IntegerType)) and have[f.name] == "string":
            return c.try_cast("double").try_cast(f.dataType).alias(f.name)
        return c.try_cast(f.dataType).alias(f.name)

    return df.select(*[cast(f) for f in schema.fields])


def table_tier(interval: Column) -> Column:
    """daily, intraday or tick; an unknown interval is an error."""
    known = F.when(interval == "1d", "daily").when(interval == "1m", "tick").when(interval.isin(*INTERVALS), "intraday")
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown interval "), F.coalesce(interval, F.lit("null")))))


def unique_key(interval: Column) -> Column:
    """Names of the columns that identify a bar of this interval."""
    base = [F.lit("symbol"), F.lit("date"), F.lit("interval")]
    return F.when(table_tier(interval) == "daily", F.array(*base)).otherwise(F.array(*base, F.lit("bar_time_utc")))


def is_intraday(interval: Column) -> Column:
    return table_tier(interval) != "daily"


def broken_invariants(df: DataFrame) -> Column:
    """Names of the construction rules that a bar breaks, in order."""
    blank = lambda n: F.coalesce(F.trim(field(df, n)), F.lit("")) == ""
    known = F.coalesce(field(df, "interval").isin(*INTERVALS), F.lit(False))
    checks = [F.when(blank(n), F.lit(f"blank_{n}")) for n in ("symbol", "source", "batch_id", "pipeline_version")]
    checks += [F.when(field(df, "date").isNull(), "missing_date"), F.when(~known, "unknown_interval")]
    checks += [F.when(known & (field(df, "interval") != "1d") & field(df, "bar_time_utc").isNull(), "missing_bar_time")]
    checks += [F.when(field(df, n).isNull() | F.isnan(field(df, n).cast("double")), F.lit(f"not_numeric_{n}")) for n in ("open", "high", "low", "close", "volume")]
    return F.array_compact(F.array(*checks))
