"""Configuration as plain data: rule definitions, stream profiles, deep merge, dotted access."""

from __future__ import annotations

import copy
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# The shared rules in the order of their evaluation, as (name, severity, action, threshold).
SHARED_RULES: tuple[tuple[str, str, str, float | None], ...] = (
    ("high_gte_low", "critical", "reject_record", None),
    ("high_gte_open", "critical", "reject_record", None),
    ("high_gte_close", "critical", "reject_record", None),
    ("low_lte_open", "critical", "reject_record", None),
    ("low_lte_close", "critical", "reject_record", None),
    ("no_null_ohlcv", "critical", "reject_record", None),
    ("price_positive", "critical", "reject_record", None),
    ("prev_close_positive", "critical", "reject_record", None),
    ("volume_positive", "warning", "flag_record", None),
    ("pre_market_volume_non_negative", "critical", "reject_record", None),
    ("vwap_between_low_and_high", "critical", "reject_record", None),
    ("price_change_pct_threshold", "warning", "flag_record", 50.0),
    ("gap_threshold", "warning", "flag_record", 15.0),
    ("corporate_action_consistency", "warning", "flag_record", None),
    ("amended_record_detected", "warning", "flag_record", None),
    ("fetch_duration_threshold", "warning", "flag_record", 30000.0),
    ("max_consecutive_missing_days", "warning", "alert", 5.0),
)
#: Stream configurations also name thresholds by these keys.
THRESHOLD_ALIASES = {"fetch_duration_ms": "fetch_duration_threshold"}

YAHOO_NULLABLE = (
    "vwap", "trade_count", "pre_market_high", "pre_market_low", "pre_market_close", "pre_market_volume",
    "post_market_high", "post_market_low", "post_market_close", "post_market_volume", "adj_factor", "exchange",
)


@dataclass(frozen=True)
class Stream:
    """A named profile of bars: intervals, history, limits and its own rules."""

    name: str
    intervals: tuple[str, ...]
    table: str
    lookback_years: int | None = None
    lookback_days: int = 0
    amendment_buffer_days: int = 3
    batch_size_days: int = 30
    max_gap_days: int = 30
    enabled: bool = True
    thresholds: dict[str, float] = field(default_factory=dict)
    additional_rules: tuple[tuple[str, str, str], ...] = ()
    disabled_rules: tuple[str, ...] = ()
    nullable: dict[str, tuple[str, ...]] = field(default_factory=dict)


_CRITICAL = ("critical", "reject_record")
STREAMS: dict[str, Stream] = {
    "daily": Stream(
        "daily", ("1d",), "market_data_daily", lookback_years=10, batch_size_days=30, max_gap_days=30,
        thresholds={"price_change_pct_threshold": 50.0, "gap_threshold": 15.0, "fetch_duration_ms": 30000.0, "max_consecutive_missing_days": 5.0},
        additional_rules=(("no_weekend_dates", *_CRITICAL), ("vwap_between_low_and_high", *_CRITICAL)), nullable={"yahoo": YAHOO_NULLABLE},
    ),
    "intraday": Stream(
        "intraday", ("1h", "4h", "15m"), "market_data_intraday", lookback_years=2, amendment_buffer_days=1, batch_size_days=7, max_gap_days=7, enabled=False,
        thresholds={"fetch_duration_ms": 15000.0}, additional_rules=(("bar_within_market_hours", "warning", "flag_record"), ("consistent_bar_spacing", "warning", "flag_record")), nullable={"yahoo": YAHOO_NULLABLE},
    ),
    "tick": Stream(
        "tick", ("5m", "1m"), "market_data_tick", lookback_days=90, amendment_buffer_days=1, batch_size_days=1, max_gap_days=1, enabled=False,
        thresholds={"fetch_duration_ms": 10000.0, "consecutive_zero_volume": 3.0, "tick_price_spike": 3.0},
        additional_rules=(("consecutive_zero_volume", "warning", "flag_record"), ("tick_price_spike", "warning", "flag_record")), nullable={"yahoo": YAHOO_NULLABLE},
    ),
}


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` laid on ``base``: dicts merge, anything else replaces; neither is changed."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


class Config:
    """Nested settings with dotted access: ``cfg.get("daily.history.lookback_years", 10)``."""

    def __init__(self, data: dict):
        self._data = data

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self._data
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return Config(at) if isinstance(at, dict) else at

    def require(self, path: str) -> Any:
        missing = object()
        if (found := self.get(path, missing)) is missing:
            raise KeyError(path)
        return found

    def to_dict(self) -> dict:
        return copy.deepcopy(self._data)

    def __contains__(self, path: str) -> bool:
        missing = object()
        return self.get(path, missing) is not missing


def load(folder: str | Path, env: str | None = None, secrets: dict[str, str] | None = None) -> Config:
    """All YAML files of a folder, merged; ``streams/*.yml`` by their stream; ``<env>.yml`` last.

    ``secrets`` maps dotted paths to environment variables that fill them.
    """
    import yaml

    folder = Path(folder)
    env = env or os.environ.get("APP_ENV", "dev")
    data: dict = {}
    names = sorted(p for p in folder.glob("*.yml") if p.stem not in ("dev", "staging", "prod"))
    for path in [*names, *sorted(folder.glob("streams/*.yml")), folder / f"{env}.yml"]:
        if path.exists():
            data = deep_merge(data, yaml.safe_load(path.read_text()) or {})
    for path, variable in (secrets or {}).items():
        if variable in os.environ:
            for part in reversed(path.split(".")):
                value = {part: os.environ[variable]} if part == path.split(".")[-1] else {part: value}
            data = deep_merge(data, value)
    return Config(data)
