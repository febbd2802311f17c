"""US equity trading calendar 2010 to 2040, from the exchange's holiday rules."""

from __future__ import annotations

from datetime import date, timedelta
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 2010, 2040
# Closures outside the rules, and dates that replace what a rule gives.
EXTRA = (date(2012, 10, 29), date(2012, 10, 30), date(2018, 12, 5), date(2022, 6, 20), date(2025, 1, 9))
REPLACED = {date(2040, 3, 30): date(2040, 4, 30)}


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th weekday (Monday 0) of a month; n = -1 is the last."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7)


def _easter(year: int) -> date:
    """Gregorian Easter by Gauss's rule as Butcher wrote it."""
    a, (b, c) = year % 19, divmod(year, 100)
    (d, e), g = divmod(b, 4), (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (a + 11 * h) // 319
    r = (2 * e + 2 * i - k - h + m + 32) % 7
    month = (h - m + r + 90) // 25
    return date(year, month, (h - m + r + month + 19) % 32)


def _observed(day: date) -> date:
    return day + timedelta({5: -1, 6: 1}.get(day.weekday(), 0))


@lru_cache(maxsize=1)
def holidays() -> tuple[date, ...]:
    """All closures that fall on weekdays, in order."""
    found = set(EXTRA)
    for y in range(FIRST_YEAR, LAST_YEAR + 1):
        new_year = date(y, 1, 1)
        if new_year.weekday() != 5:  # a Saturday's New Year isn't moved into the old year
            found.add(_observed(new_year))
        found |= {_nth(y, 1, 0, 3), _nth(y, 2, 0, 3), _easter(y) - timedelta(2), _nth(y, 5, 0, -1), _observed(date(y, 7, 4)), _nth(y, 9, 0, 1), _nth(y, 11, 3, 4), _observed(date(y, 12, 25))}
    return tuple(sorted(REPLACED.get(d, d) for d in found))


def holiday_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in holidays()], "date date")


def is_trading_day(day: Column) -> Column:
    """Neither weekend nor holiday; a literal set, so no join."""
    return (F.weekday(day) < 5) & ~day.isin(*holidays())


def days(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """All days from start to end with ``is_trading_day``; none if start is later."""
    each = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(each).alias("date")).withColumn("is_trading_day", is_trading_day(F.col("date")))


def trading_days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    return days(spark, F.lit(start).cast("date"), F.lit(end).cast("date")).where("is_trading_day").select("date")


def trading_day_count(start: Column, end: Column) -> Column:
    """How many trading days lie between two days, both included; 0 if the end comes first."""
    each = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.size(F.filter(each, is_trading_day)).cast("long")


def last_trading_day(day: Column) -> Column:
    """The trading day on or before; no closure lasts for ten days."""
    back = F.sequence(day, F.date_sub(day, 10), F.expr("interval -1 day"))
    return F.element_at(F.filter(back, is_trading_day), 1)


def is_market_open(utc: Column) -> Column:
    """A weekday from 09:30 to before 16:00 in New York; holidays play no part."""
    local = F.from_utc_timestamp(utc, "America/New_York")
    return (F.weekday(local) < 5) & F.date_format(local, "HH:mm").between("09:30", "15:59")
