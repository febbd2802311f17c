"""Derived columns of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.schemas import field

CORE = ("open", "high", "low", "close", "volume", "adj_close", "prev_close", "vwap")
OPTIONAL = ("trade_count", "pre_market_volume", "post_market_volume", "shares_outstanding", "exchange")


def has_corporate_action(df: DataFrame) -> Column:
    return field(df, "split_factor").isNotNull() | (F.coalesce(field(df, "dividend_amount"), F.lit(0.0)) > 0)


def price_range(df: DataFrame) -> Column:
    return field(df, "high") - field(df, "low")


def _from_prev(df: DataFrame, name: str) -> Column:
    prev = field(df, "prev_close")
    return F.when(prev > 0, (field(df, name) - prev) / prev * 100)


def daily_return_pct(df: DataFrame) -> Column:
    return _from_prev(df, "close")


def gap_pct(df: DataFrame) -> Column:
    return _from_prev(df, "open")


def is_gap_up(df: DataFrame) -> Column:
    return gap_pct(df) > 0.5


def is_gap_down(df: DataFrame) -> Column:
    return gap_pct(df) < -0.5


def with_prev_close(df: DataFrame) -> DataFrame:
    """prev_close where it is missing: the close before it in the same symbol and interval."""
    order = [F.col(c) for c in ("date", "bar_time_utc") if c in df.columns]
    before = F.lag("close").over(W.partitionBy("symbol", "interval").orderBy(*order))
    return df.withColumn("prev_close", F.coalesce(field(df, "prev_close"), before))


def _share(df: DataFrame, names: list[str], points: float) -> Column:
    if not names:
        return F.lit(points)
    present = sum((field(df, n).isNotNull().cast("int") for n in names), F.lit(0))
    return present / F.lit(len(names)) * F.lit(points)


def completeness_pct(df: DataFrame, nullable: tuple[str, ...] = ()) -> Column:
    """0 to 100: core fields weigh 80, optional ones 20; fields a provider can't give don't count."""
    core = [n for n in CORE if n not in nullable]
    optional = [n for n in OPTIONAL if n not in nullable]
    return F.bround(_share(df, core, 80.0) + _share(df, optional, 20.0), 1)


def completeness_by_source(df: DataFrame, nullable: dict[str, tuple[str, ...]]) -> Column:
    """Completeness with each row's own source's nullable fields."""
    out = completeness_pct(df)
    for source, names in nullable.items():
        out = F.when(field(df, "source") == source, completeness_pct(df, names)).otherwise(out)
    return out
