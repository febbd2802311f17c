"""Instrument universe: lookups, merges, enrichment, and what a sync inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def effective_history_start(df: DataFrame) -> Column:
    return F.coalesce("history_start", "ipo_date")


def active(feed: DataFrame, listing: DataFrame, instrument: DataFrame, symbols: tuple[str, ...] = (), asset_classes: tuple[str, ...] = (), stream: str | None = None) -> DataFrame:
    """Active feeds with their current listing and instrument, by priority and symbol; empty lists don't filter."""
    if stream is not None:
        feed = feed.where(F.col("stream") == stream)
    if symbols:
        listing = listing.where(F.upper("symbol").isin(*[s.upper() for s in symbols]))
    if asset_classes:
        instrument = instrument.where(F.col("asset_class").isin(*asset_classes))
    out = feed.where("is_active").join(listing.where("is_current"), "instrument_id").join(instrument, "instrument_id")
    return out.orderBy("priority", "symbol")


def select_tickers(tickers: DataFrame, symbols: tuple[str, ...] = (), asset_classes: tuple[str, ...] = (), sectors: tuple[str, ...] = ()) -> DataFrame:
    """Active tickers of these symbols, classes and sectors; an empty list doesn't filter."""
    out = tickers.where("active")
    for column, wanted in (("symbol", symbols), ("asset_class", asset_classes), ("sector", sectors)):
        if wanted:
            out = out.where(F.upper(column).isin(*[w.upper() for w in wanted]))
    return out


def lookup(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.col("symbol") == symbol.upper()).limit(1)


def symbols(df: DataFrame, active_only: bool = True) -> DataFrame:
    return (df.where("active") if active_only else df).select("symbol")


def overlay(base: DataFrame, top: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row a symbol of either frame; columns of ``top`` count where it has them."""
    joined = base.alias("b").join(top.alias("t"), "symbol", "full_outer")
    have = lambda a, df, c: F.col(f"{a}.{c}") if c in df.columns else F.lit(None)
    return joined.select("symbol", *[F.coalesce(have("t", top, c), have("b", base, c)).alias(c) for c in columns])


def new_symbols(incoming: DataFrame, listing: DataFrame) -> DataFrame:
    """Incoming instruments that no current listing has."""
    return incoming.join(listing.where("is_current").select("symbol"), "symbol", "left_anti")


def preview(rows: DataFrame, n: int = 5, order: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The first ``n`` rows by ``order``, nulls last, for a person to look at; each task keeps ``n`` rows, not its whole sort."""
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def to_enrich(incoming: DataFrame, members: DataFrame, existing: DataFrame) -> DataFrame:
    """Universe members that are new or have no figi yet. ``existing``: symbol, figi."""
    wanted = incoming.join(members.select("symbol"), "symbol", "left_semi")
    return wanted.join(existing.where("figi is not null").select("symbol"), "symbol", "left_anti")


def enrich_figi(rows: DataFrame, mapping: DataFrame, batch_size: int = 10) -> DataFrame:
    """Fill figi and isin from a landed mapping (symbol, pos, figi, isin); a miss leaves the row as it was.

    The first match of a symbol counts. ``batch_no`` tells which request of
    ``batch_size`` symbols a row goes with, all symbols in order; rows are
    ranked within blocks of symbols' first letters, and a block starts where
    the ones before end, so that no single task sorts all rows.
    """
    first = mapping.groupBy("symbol").agg(F.min(F.struct("pos", "figi", "isin")).alias("m")).select("symbol", F.col("m.figi").alias("new_figi"), F.col("m.isin").alias("new_isin"))
    place = F.row_number().over(W.partitionBy("block").orderBy("symbol")) - 1
    rows = rows.withColumn("block", F.substring("symbol", 1, 2))
    # One row a block: some hundreds.
    starts = rows.groupBy("block").agg(F.count("*").alias("n")).select("block", (F.sum("n").over(W.orderBy("block")) - F.col("n")).alias("before"))
    made = rows.join(first, "symbol", "left").join(starts, "block").withColumn("batch_no", F.floor((F.col("before") + place) / batch_size).cast("int")).drop("before")
    return made.withColumns({"figi": F.coalesce("new_figi", "figi"), "isin": F.coalesce("new_isin", "isin")}).drop("new_figi", "new_isin")


def enrich_con_id(rows: DataFrame, contracts: DataFrame) -> DataFrame:
    """Fill missing con_ids from contracts (symbol, sec_type, pos, con_id): the first of the instrument's type with an id."""
    kind = F.when(F.col("asset_class") == "etf", "ETF").otherwise("STK")
    first = contracts.where("con_id is not null").groupBy(F.col("symbol").alias("s"), F.col("sec_type").alias("t")).agg(F.min_by("con_id", "pos").alias("found"))
    out = rows.withColumn("t0", kind).join(first, (F.col("symbol") == F.col("s")) & (F.col("t0") == F.col("t")), "left")
    return out.withColumn("con_id", F.coalesce("con_id", "found")).drop("s", "t", "t0", "found")


def resolve_con_ids(symbols: DataFrame, cache: DataFrame, contracts: DataFrame) -> DataFrame:
    """(symbol, con_id, origin) of each distinct symbol: from the cache, else its first contract with an id, else none.

    ``origin`` is cached, found or missing; the found rows are what the cache
    gains. ``cache``: symbol, con_id, one row a symbol. Null symbols are left out.
    """
    wanted = symbols.where("symbol is not null").select("symbol").distinct()
    known = cache.select("symbol", F.col("con_id").alias("cached"))
    # Contracts are cut to the symbols that the cache lacks before their first is taken.
    lacking = wanted.join(known.where("cached is not null").select("symbol"), "symbol", "left_anti")
    first = contracts.where("con_id is not null").join(lacking, "symbol", "left_semi").groupBy("symbol").agg(F.min_by("con_id", "pos").alias("found"))
    out = wanted.join(known, "symbol", "left").join(first, "symbol", "left")
    origin = F.when(F.col("cached").isNotNull(), "cached").when(F.col("found").isNotNull(), "found").otherwise("missing")
    return out.select("symbol", F.coalesce("cached", "found").alias("con_id"), origin.alias("origin"))


def assign_ids(rows: DataFrame, id_column: str, order: tuple[str, ...], after: int) -> DataFrame:
    """Surrogate ids after the highest there is, by the natural key.

    Ids come from range partitions and each one's offset, not from one sort.
    """
    ranged = rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id())
    from tidemark.operators import _scratch

    ranged = _scratch.written(ranged, "ids")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    offset = sizes.select("__p", (F.sum("n").over(W.orderBy("__p")) - F.col("n")).alias("offset"))
    place = F.row_number().over(W.partitionBy("__p").orderBy(*order))
    return ranged.withColumn("__n", place).join(F.broadcast(offset), "__p").withColumn(id_column, F.lit(after) + F.col("offset") + F.col("__n")).drop("__p", "__n", "offset")


def recover_ids(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """instrument_id by the natural key (symbol, exchange_mic); a null exchange matches a null one."""
    have = listing.where("is_current").select(F.col("symbol").alias("s"), F.col("exchange_mic").alias("m"), "instrument_id")
    return rows.join(have, (F.col("symbol") == F.col("s")) & F.col("exchange_mic").eqNullSafe(F.col("m")), "left").drop("s", "m")


def new_memberships(rows: DataFrame, membership: DataFrame) -> DataFrame:
    """(instrument_id, universe_code) of ``rows``' universe_codes that the table doesn't have."""
    wanted = rows.select("instrument_id", F.explode("universe_codes").alias("universe_code")).distinct()
    return wanted.join(membership.select("instrument_id", "universe_code"), ["instrument_id", "universe_code"], "left_anti")


def new_feeds(instrument: DataFrame, feed: DataFrame) -> DataFrame:
    return instrument.join(feed.select("instrument_id"), "instrument_id", "left_anti")


def summary(instrument: DataFrame, membership: DataFrame, feed: DataFrame, distinct: bool = False) -> DataFrame:
    """Counts by asset class. An instrument of two universes counts twice, unless ``distinct``."""
    joined = instrument.alias("i").join(membership.where("is_active").alias("m"), "instrument_id", "left").join(feed.where("is_active").select("instrument_id", F.lit(True).alias("fed")), "instrument_id", "left")
    if distinct:
        each = lambda c: F.count_distinct(F.when(c, F.col("instrument_id")))
        return joined.groupBy("asset_class").agg(F.count_distinct("instrument_id").alias("total"), each(F.col("universe_code").isNotNull()).alias("in_universe"), each(F.col("fed")).alias("active_feeds")).orderBy("asset_class")
    each = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return joined.groupBy("asset_class").agg(F.count("*").alias("total"), each(F.col("universe_code").isNotNull()).alias("in_universe"), each(F.col("fed")).alias("active_feeds")).orderBy("asset_class")


def feed_report(feed: DataFrame, listing: DataFrame) -> DataFrame:
    out = feed.join(listing.where("is_current"), "instrument_id").select("batch_group", "priority", "symbol", "is_active")
    return out.orderBy("batch_group", "priority", "symbol")


def reclassify(instrument: DataFrame, etf_ids: DataFrame) -> DataFrame:
    """asset_class set to etf for these instruments, everything else as it was."""
    marked = instrument.join(etf_ids.select("instrument_id", F.lit(True).alias("__etf")).distinct(), "instrument_id", "left")
    return marked.withColumn("asset_class", F.when(F.col("__etf"), "etf").otherwise(F.col("asset_class"))).drop("__etf")


def rename_listing(listing: DataFrame, renames: DataFrame, day: Column) -> DataFrame:
    """Listings after renames (old_symbol, new_symbol): the old row closes on ``day``, a new one opens."""
    marked = listing.join(renames.select(F.col("old_symbol").alias("symbol"), "new_symbol"), "symbol", "left").withColumn("hit", F.col("is_current") & F.col("new_symbol").isNotNull())
    closed = marked.withColumns({"valid_to": F.when(F.col("hit"), day).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~F.col("hit")}).select(*listing.columns)
    opened = marked.where("hit").withColumns({"symbol": F.col("new_symbol"), "valid_from": day, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}).select(*listing.columns)
    return closed.unionByName(opened)


def as_of(rows: DataFrame, listing: DataFrame, day: str = "date") -> DataFrame:
    """Add to rows of an instrument the ``symbol`` and ``exchange_mic`` it had on that day; null where it wasn't listed.

    ``valid_from`` belongs to a listing, ``valid_to`` no longer; a null start
    or end is open. Listings are dealt to the years that they touch within the
    years of ``rows``, so the join is one of equal keys, and as many rows of a
    listing as it has years there. Of listings that overlap, the later counts.
    """
    span = rows.agg(F.min(F.year(day)).alias("a"), F.max(F.year(day)).alias("z")).first()
    first, last = (span.a, span.z) if span.a is not None else (1, 0)
    a, z = F.greatest(F.coalesce(F.year("valid_from"), F.lit(first)), F.lit(first)), F.least(F.coalesce(F.year("valid_to"), F.lit(last)), F.lit(last))
    years = F.when(a <= z, F.sequence(a, z)).otherwise(F.array().cast("array<int>"))
    binned = listing.select(F.col("instrument_id").alias("__id"), F.explode(years).alias("__year"), F.struct("valid_from", "valid_to", "symbol", "exchange_mic").alias("l"))
    # One row for each instrument and year, its listings in order: a row of ``rows`` meets one row, never several.
    by_year = binned.groupBy("__id", "__year").agg(F.array_sort(F.collect_list("l")).alias("__l"))
    joined = rows.join(by_year, (F.col("instrument_id") == F.col("__id")) & (F.year(day) == F.col("__year")), "left")
    holds = F.filter("__l", lambda l: F.coalesce(l["valid_from"] <= F.col(day), F.lit(True)) & F.coalesce(l["valid_to"] > F.col(day), F.lit(True)))
    found = F.try_element_at(holds, F.lit(-1))
    return joined.withColumns({"symbol": found["symbol"], "exchange_mic": found["exchange_mic"]}).drop("__id", "__year", "__l")
