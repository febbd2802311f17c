"""Operators on the order of bars: gaps, runs, spikes, spacing, indicators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.calendar import is_trading_day

MINUTES = {"1h": 60, "4h": 240, "15m": 15, "5m": 5, "1m": 1}


def missing_trading_days(bars: DataFrame) -> DataFrame:
    """(symbol, date): trading days between a symbol's first and last bar that have no bar."""
    span = bars.where("date is not null").groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    wanted = span.select("symbol", F.explode(F.sequence("a", "z")).alias("date")).where(is_trading_day(F.col("date")))
    return wanted.join(bars.select("symbol", "date"), ["symbol", "date"], "left_anti")


def zero_volume_runs(bars: DataFrame, at_least: int = 3, time: str = "date") -> DataFrame:
    """Runs of bars without volume, one row for each of ``at_least`` bars or more."""
    bars = bars.select("symbol", "interval", F.col(time).alias("date"), "volume")
    order = W.partitionBy("symbol", "interval").orderBy("date")
    zero = F.coalesce(F.col("volume"), F.lit(0)) <= 0
    island = F.row_number().over(order) - F.row_number().over(W.partitionBy("symbol", "interval", zero).orderBy("date"))
    runs = bars.select("symbol", "interval", "date", zero.alias("zero"), island.alias("island")).where("zero")
    return runs.groupBy("symbol", "interval", "island").agg(F.min("date").alias("run_start"), F.max("date").alias("run_end"), F.count("*").alias("n_bars")).where(F.col("n_bars") >= at_least).drop("island")


def price_spikes(bars: DataFrame, sigmas: float = 3.0, window: int = 20, order: str = "date") -> DataFrame:
    """Bars whose close lies more than ``sigmas`` deviations off the mean of the ``window`` bars before."""
    before = W.partitionBy("symbol", "interval").orderBy(order).rowsBetween(-window, -1)
    # Sums of whole cents, so that the order of rows doesn't show in the last bits.
    cents = F.round(F.col("close") * 100).cast("long")
    n, s, q = F.count(cents).over(before), F.sum(cents).over(before), F.sum((cents * cents).cast("decimal(38,0)")).over(before)
    made = bars.withColumns({"n_before": n, "s": s, "q": q, "cents": cents}).where(F.col("n_before") == window)
    # |x - s/n| > k * sd  <=>  (n x - s)^2 > k^2 (n q - s^2), all in whole numbers
    left = F.pow(F.col("cents").cast("double") * window - F.col("s").cast("double"), F.lit(2.0))
    right = F.lit(sigmas * sigmas) * (F.col("q").cast("double") * window - F.pow(F.col("s").cast("double"), F.lit(2.0)))
    return made.where(left > right).select("symbol", "interval", order, "close")


def spacing_errors(bars: DataFrame, time: str = "bar_time") -> DataFrame:
    """Bars of an interval in minutes that don't follow the one before by exactly that."""
    order = W.partitionBy("symbol", "interval").orderBy(time)
    pairs = [x for k, v in MINUTES.items() for x in (F.lit(k), F.lit(v))]
    gap = (F.unix_timestamp(F.col(time).cast("timestamp")) - F.unix_timestamp(F.lag(time).over(order).cast("timestamp"))) / 60
    made = bars.withColumn("gap_minutes", gap.cast("long")).withColumn("expected", F.element_at(F.create_map(*pairs), F.col("interval")))
    return made.where("gap_minutes != expected").select("symbol", "interval", time, "gap_minutes")


def indicators(bars: DataFrame) -> DataFrame:
    """Moving averages, 14-bar RSI and stochastic, 80-bar high and 15-bar support of each bar.

    Windows are by rows; the RSI is that of plain sums. Values are null until
    a window is full. ``trend`` has the exponential averages.
    """
    order = W.partitionBy("symbol", "interval").orderBy("date")
    last = lambda n: order.rowsBetween(1 - n, 0)
    dec = lambda c: c.cast("decimal(18,6)")
    change = F.col("close") - F.lag("close").over(order)
    made = bars.withColumns({"gain": dec(F.greatest(change, F.lit(0.0))), "loss": dec(F.greatest(-change, F.lit(0.0))), "seen": F.row_number().over(order)})
    full = lambda n, c: F.when(F.col("seen") >= n, c)
    mean = lambda c, n: F.sum(dec(F.col(c))).over(last(n)).cast("double") / n
    gains, losses = (F.sum(c).over(last(14)).cast("double") for c in ("gain", "loss"))
    low, high = F.min("low").over(last(14)), F.max("high").over(last(14))
    return made.select(
        "symbol", "interval", "date", "close",
        full(15, mean("close", 15)).alias("sma_15"), full(45, mean("close", 45)).alias("sma_45"), full(20, F.sum("volume").over(last(20)) / 20).alias("avg_volume_20"),
        full(15, F.when(losses == 0, 100.0).otherwise(100 - 100 / (1 + gains / losses))).alias("rsi_14"),
        full(14, F.when(high > low, (F.col("close") - low) / (high - low) * 100)).alias("stoch_k"),
        full(80, F.max("high").over(last(80))).alias("high_80"), full(15, F.min("low").over(last(15))).alias("support_15"),
    )


BLOCK = 128  # rows whose weights are summed relative to one place, unless weights would underflow
LEAST_WEIGHT = 250  # decimal places


def _block_rows(shares_left: list[float]) -> int:
    """Rows of a block: so many that no weight within it gets lost."""
    steepest = -math.log10(max(min(shares_left), 1e-300))
    return max(1, min(BLOCK, int(LEAST_WEIGHT / steepest) if steepest else BLOCK))


def _decayed_sums(df: DataFrame, key: list[str], place: str, columns: dict[str, tuple[str, float]], levels: int = 2) -> DataFrame:
    """Add for each ``name: (column, old)`` the sum over rows up to this one of column * old ** distance, by ``place`` within ``key``.

    A prefix scan over affine maps: a block's rows are summed by themselves;
    the ends of blocks are a series of the same kind, ``old ** rows`` being its
    weight, and are scanned in the same way; what enters a block is one row for
    it, joined by its number. After ``levels`` scans, which leave one entry in
    ``BLOCK ** levels`` rows, the ends that are left are folded in order.
    """
    size = _block_rows([old for _, old in columns.values()])
    placed = df.withColumns({"__b": F.floor(F.col(place) / size).cast("long"), "__i": F.col(place) % size})
    inside = W.partitionBy(*key, "__b").orderBy("__i")
    power = lambda name, n: F.pow(F.lit(columns[name][1]), n)
    local = {f"__l_{n}": F.sum(F.col(c) / power(n, F.col("__i"))).over(inside) * power(n, F.col("__i")) for n, (c, _) in columns.items()}
    placed = placed.withColumns(local)
    ends = placed.groupBy(*key, "__b").agg(F.max_by(F.struct(*local), "__i").alias("e")).select(*key, "__b", *[F.col(f"e.__l_{n}").alias(f"__e_{n}") for n in columns])
    if levels > 1 and size > 1:
        inner = {n: (f"__e_{n}", old**size) for n, (_, old) in columns.items()}
        scanned = _decayed_sums(ends.withColumnRenamed("__b", "__block"), key, "__block", inner, levels - 1)
        carried = scanned.select(*key, (F.col("__block") + 1).alias("__b"), *[F.col(n).alias(f"__c_{n}") for n in columns])
    else:
        step = lambda acc, x: F.struct(*[(acc[n] * F.lit(old**size) + x[f"__e_{n}"]).alias(n) for n, (_, old) in columns.items()])
        nothing = F.struct(*[F.lit(0.0).alias(n) for n in columns])
        ordered = ends.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("__b", *[f"__e_{n}" for n in columns]))).alias("__ends"))
        each = F.transform("__ends", lambda x, i: F.struct((x["__b"] + 1).alias("b"), F.aggregate(F.slice("__ends", F.lit(1), i + 1), nothing, step).alias("c")))
        carried = ordered.select(*key, F.explode(each).alias("x")).select(*key, F.col("x.b").alias("__b"), *[F.col(f"x.c.{n}").alias(f"__c_{n}") for n in columns])
    out = placed.join(carried, [*key, "__b"], "left")
    made = {n: F.col(f"__l_{n}") + F.coalesce(f"__c_{n}", F.lit(0.0)) * power(n, F.col("__i") + 1) for n in columns}
    return out.select(*df.columns, *[c.alias(n) for n, c in made.items()])


def smoothed(bars: DataFrame, columns: dict[str, tuple[str, float]], time: str = "date") -> DataFrame:
    """Exponential averages over a symbol's whole series: ``columns`` maps a new name to (column, share of the newest value).

    The first average is the first value; values mustn't be null. A share of 1
    is the value itself. The recurrence is linear, so it is a scan over blocks.
    """
    same = {name: c for name, (c, share) in columns.items() if share >= 1.0}
    rest = {name: of for name, of in columns.items() if name not in same}
    value = {n: F.col(c).cast("double").alias(n) for n, c in same.items()}
    if not rest:
        return bars.select(*bars.columns, *value.values())
    key = ["symbol", "interval"]
    order = W.partitionBy(*key).orderBy(time)
    firsts = {f"__f_{n}": F.first(c).over(order) for n, (c, _) in rest.items()}
    placed = bars.withColumns({"__n": F.row_number().over(order) - 1, **firsts})
    made = _decayed_sums(placed, key, "__n", {f"__s_{n}": (c, 1.0 - share) for n, (c, share) in rest.items()})
    for n, (_, share) in rest.items():
        value[n] = (F.col(f"__s_{n}") * share + F.col(f"__f_{n}") * F.pow(F.lit(1.0 - share), F.col("__n") + 1)).alias(n)
    return made.select(*bars.columns, *[value[n] for n in columns])


def ema(bars: DataFrame, span: int, column: str = "close", time: str = "date") -> DataFrame:
    """Exponential moving average of this span over a symbol's whole series; bars without a value are left out."""
    return smoothed(bars.where(F.col(column).isNotNull()), {f"ema_{span}": (column, 2.0 / (span + 1))}, time)


def trend(bars: DataFrame) -> DataFrame:
    """ema_15, ema_45, MACD (12, 26) with its signal (9), ATR of 14 bars (an average of share 1/14) and stochastic %D.

    Bars that lack high, low or close are left out. Values are rounded to four
    places. An average of an average is a weighted difference of both averages
    of the values themselves, so the signal needs no second pass.
    """
    order = W.partitionBy("symbol", "interval").orderBy("date")
    seen = bars.where("high is not null and low is not null and close is not null")
    before, last = F.lag("close").over(order), order.rowsBetween(-13, 0)
    low, high = F.min("low").over(last), F.max("high").over(last)
    seen = seen.select("symbol", "interval", "date", "close", F.greatest(F.abs(F.col("high") - F.col("low")), F.abs(F.col("high") - before), F.abs(F.col("low") - before)).alias("true_range"), F.when(F.row_number().over(order) >= 14, F.when(high > low, (F.col("close") - low) / (high - low) * 100)).alias("stoch_k"))
    k = F.col("stoch_k").cast("decimal(20,8)")
    three = order.rowsBetween(-2, 0)
    seen = seen.withColumn("stoch_d", F.when(F.count(k).over(three) == 3, F.sum(k).over(three).cast("double") / 3))
    share = {n: 2.0 / (n + 1) for n in (9, 12, 15, 26, 45)}
    made = smoothed(seen, {**{f"ema_{n}": ("close", a) for n, a in share.items()}, "atr_14": ("true_range", 1 / 14)})

    def twice(n: int) -> Column:
        """The average of span 9 of the average of span n."""
        old, old9 = 1 - share[n], 1 - share[9]
        return (F.col(f"ema_{n}") * (share[9] * old) - F.col("ema_9") * (share[n] * old9)) / (old - old9)

    made = made.withColumns({"macd": F.col("ema_12") - F.col("ema_26"), "macd_signal": twice(12) - twice(26)})
    return made.select("symbol", "interval", "date", *[F.round(c, 4).alias(c) for c in ("ema_15", "ema_45", "macd", "macd_signal", "atr_14", "stoch_d")])
