"""Data-quality rules as columns: each gives a message where it fires and null where it passes.

A null (or NaN) operand passes, except for ``no_null_ohlcv``. Text that stands where
a number should and can't be read as one makes the rules that need it warn.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark import schemas as S

EPS = 1e-9
PRICES = ("open", "high", "low", "close")
READ = "__read_"


def with_read(df: DataFrame) -> DataFrame:
    """Add what text columns that should hold something else read as, once for all rules; null where they can't."""
    made = {}
    for f in S.BARS_SCHEMA.fields:
        if f.name != "date" and f.name in df.columns and isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType):
            whole = isinstance(f.dataType, (T.LongType, T.IntegerType))
            made[READ + f.name] = F.col(f.name).try_cast("double").try_cast(f.dataType) if whole else F.col(f.name).try_cast(f.dataType)
    return df.withColumns(made) if made else df


class Bar:
    """Columns of a bar as their declared types; a double that is NaN reads as null.

    ``unread`` collects, by column, whether a value can't be read as its type
    (of columns that ``with_read`` has read).
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.unread: dict[str, Column] = {}

    def __getattr__(self, name: str) -> Column:
        c, kind = S.field(self.df, name), self.types.get(name)
        if READ + name in self.types:
            c, kind = F.col(READ + name), self.types[READ + name]
            self.unread[name] = self.raw(name).isNotNull() & c.isNull()
        return F.when(~F.isnan(c), c) if isinstance(kind, T.DoubleType) else c

    def raw(self, name: str) -> Column:
        return S.field(self.df, name)


def _below(a: str, b: str) -> Callable[[Bar, float | None], Column]:
    return lambda r, t: F.when(getattr(r, a) < getattr(r, b) - EPS, F.concat(F.lit(f"{a} "), getattr(r, a).cast("string"), F.lit(f" is below {b} "), getattr(r, b).cast("string")))


def _above(a: str, b: str) -> Callable[[Bar, float | None], Column]:
    return lambda r, t: F.when(getattr(r, a) > getattr(r, b) + EPS, F.concat(F.lit(f"{a} "), getattr(r, a).cast("string"), F.lit(f" is above {b} "), getattr(r, b).cast("string")))


def _null_ohlcv(r: Bar, t: float | None) -> Column:
    return F.coalesce(*[F.when(r.raw(n).isNull(), f"{n} is null") for n in (*PRICES, "volume")])


def _not_positive(*names: str) -> Callable[[Bar, float | None], Column]:
    return lambda r, t: F.coalesce(*[F.when(getattr(r, n) <= 0, F.concat(F.lit(f"{n} isn't positive: "), getattr(r, n).cast("string"))) for n in names])


def _negative(name: str) -> Callable[[Bar, float | None], Column]:
    return lambda r, t: F.when(getattr(r, name) < 0, F.concat(F.lit(f"{name} is negative: "), getattr(r, name).cast("string")))


def _vwap(r: Bar, t: float | None) -> Column:
    return F.when((r.vwap < r.low - EPS) | (r.vwap > r.high + EPS), F.concat(F.lit("vwap lies outside low and high: "), r.vwap.cast("string")))


def _moved(name: str) -> Callable[[Bar, float | None], Column]:
    def rule(r: Bar, t: float | None) -> Column:
        pct = F.when(r.prev_close > 0, F.abs((getattr(r, name) - r.prev_close) / r.prev_close) * 100)
        return F.when(pct > F.lit(float(t)), F.format_string(f"{name} moved %.1f%% from prev_close (limit %s%%)", pct, F.lit(str(t))))

    return rule


def _corporate(r: Bar, t: float | None) -> Column:
    paid = F.coalesce(r.dividend_amount, F.lit(0.0)) > 0
    told = F.concat_ws(
        "; ",
        F.when(F.coalesce(r.is_ex_split_date, F.lit(False)) & r.split_factor.isNull(), "ex-split date without split_factor"),
        F.when(F.coalesce(r.is_ex_dividend_date, F.lit(False)) & ~paid, "ex-dividend date without dividend_amount"),
        F.when(F.coalesce(r.has_corporate_action, F.lit(False)) & r.split_factor.isNull() & ~paid, "corporate action without split or dividend"),
    )
    return F.nullif(told, F.lit(""))


def _amended(r: Bar, t: float | None) -> Column:
    return F.when(r.is_amended, "amends a stored record")


def _slow(r: Bar, t: float | None) -> Column:
    return F.when(r.fetch_duration_ms > F.lit(float(t)), F.concat(F.lit("fetch took ms: "), r.fetch_duration_ms.cast("string")))


def _weekend(r: Bar, t: float | None) -> Column:
    raw = r.raw("date")
    iso = F.substring(raw.cast("string"), 1, 10)
    day = F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso.try_cast("date"))
    return F.when(raw.isNotNull() & (day.isNull() | (F.weekday(day) >= 5)), F.concat(F.lit("not a weekday: "), raw.cast("string")))


def _market_hours(r: Bar, t: float | None) -> Column:
    clock = F.substring(r.bar_time_eastern, 12, 5)
    return F.when((clock < "09:30") | (clock >= "16:00"), F.concat(F.lit("bar outside market hours: "), clock))


def _batch_level(r: Bar, t: float | None) -> Column:
    return F.lit(None).cast("string")


#: All rules by name. Those on a batch's order are window operators (``operators.sequence``) and never fire here.
REGISTRY: dict[str, Callable[[Bar, float | None], Column]] = {
    "high_gte_low": _below("high", "low"),
    "high_gte_open": _below("high", "open"),
    "high_gte_close": _below("high", "close"),
    "low_lte_open": _above("low", "open"),
    "low_lte_close": _above("low", "close"),
    "volume_positive": _not_positive("volume"),
    "price_positive": _not_positive(*PRICES),
    "no_weekend_dates": _weekend,
    "price_change_pct_threshold": _moved("close"),
    "no_null_ohlcv": _null_ohlcv,
    "max_consecutive_missing_days": _batch_level,
    "vwap_between_low_and_high": _vwap,
    "prev_close_positive": _not_positive("prev_close"),
    "trade_count_positive": _not_positive("trade_count"),
    "gap_threshold": _moved("open"),
    "amended_record_detected": _amended,
    "fetch_duration_threshold": _slow,
    "pre_market_volume_non_negative": _negative("pre_market_volume"),
    "corporate_action_consistency": _corporate,
    "bar_within_market_hours": _market_hours,
    "consistent_bar_spacing": _batch_level,
    "consecutive_zero_volume": _batch_level,
    "tick_price_spike": _batch_level,
}


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    action: str
    threshold: float | None = None


def rule_set(stream: C.Stream | None = None) -> list[Rule]:
    """Shared rules with the stream's thresholds, less its disabled ones, then its additional ones.

    A rule named twice counts once, in its first place; an unknown one is an error.
    """
    limits = {C.THRESHOLD_ALIASES.get(k, k): v for k, v in (stream.thresholds if stream else {}).items()}
    rules = [Rule(n, s, a, limits.get(n, t)) for n, s, a, t in C.SHARED_RULES if not stream or n not in stream.disabled_rules]
    rules += [Rule(n, s, a, limits.get(n)) for n, s, a in (stream.additional_rules if stream else ())]
    out: dict[str, Rule] = {}
    for r in rules:
        if r.name not in REGISTRY:
            raise ValueError(f"unknown rule {r.name}")
        out.setdefault(r.name, r)
    return list(out.values())


def _applied(df: DataFrame, r: Rule) -> Column:
    """(rule, severity, action, message) of one rule; one that can't be evaluated only warns, whatever its severity."""
    bar = Bar(df)
    message = REGISTRY[r.name](bar, r.threshold)
    severity, action = F.lit(r.severity), F.lit(r.action)
    if bar.unread:
        error = F.coalesce(*[F.when(c, F.concat(F.lit(f"Rule evaluation error: {n} can't be read: "), bar.raw(n))) for n, c in bar.unread.items()])
        failed = message.isNull() & error.isNotNull()
        severity, action = F.when(failed, "warning").otherwise(severity), F.when(failed, "flag_record").otherwise(action)
        message = F.coalesce(message, error)
    return F.struct(F.lit(r.name).alias("rule"), severity.alias("severity"), action.alias("action"), message.alias("message"))


def fired(df: DataFrame, rules: list[Rule]) -> Column:
    """The rules that fire on a row, in order: array of (rule, severity, action, message). Alerts aren't for rows."""
    each = [_applied(df, r) for r in rules if r.action != "alert"]
    return F.filter(F.array(*each), lambda x: x["message"].isNotNull())
