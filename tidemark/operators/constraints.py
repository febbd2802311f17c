"""Constraints checked before rows are stored: nulls, unique keys, foreign keys, defaults and ids."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators._scratch import discard, written
from tidemark.operators.universe import assign_ids
from tidemark.schemas import TABLES
from tidemark.store import TableStore


@dataclass(frozen=True)
class Constraints:
    """What a table asks of its rows. ``foreign`` maps a column to the (table, column) that must know its values."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)
    identity: str | None = None


_OF_INSTRUMENT = {"instrument_id": ("instrument", "instrument_id")}
DECLARED: dict[str, Constraints] = {
    "instrument": Constraints(("asset_class",), (("instrument_id",),), identity="instrument_id"),
    "instrument_listing": Constraints(
        ("instrument_id", "symbol", "currency", "valid_from", "is_current"), (("listing_id",),), _OF_INSTRUMENT, {"currency": "USD", "is_current": True}, "listing_id",
    ),
    "universe_membership": Constraints(
        ("instrument_id", "universe_code", "is_active", "added_date"), (("membership_id",),), _OF_INSTRUMENT, {"is_active": True}, "membership_id",
    ),
    "ticker_feed_config": Constraints(
        ("instrument_id", "stream", "batch_group", "priority", "is_active"), (("feed_id",), ("instrument_id", "stream")), _OF_INSTRUMENT,
        {"stream": "daily", "batch_group": "A", "priority": 5, "is_active": True}, "feed_id",
    ),
    "ingestion_watermark": Constraints(
        ("instrument_id", "stream", "record_count", "status", "consecutive_failures"), (("instrument_id", "stream"),), _OF_INSTRUMENT,
        {"stream": "daily", "record_count": 0, "status": "active", "consecutive_failures": 0},
    ),
    "ingestion_command": Constraints(("instrument_id", "command"), (("command_id",),), _OF_INSTRUMENT, identity="command_id"),
}


class ConstraintError(ValueError):
    """Rows that a table refuses; nothing was stored."""


def with_defaults(rows: DataFrame, c: Constraints) -> DataFrame:
    """Declared defaults in place of nulls and of columns that aren't there."""
    kept = {n: F.coalesce(F.col(n), F.lit(v)) if n in rows.columns else F.lit(v) for n, v in c.defaults.items()}
    return rows.withColumns(kept) if kept else rows


def broken(rows: DataFrame, c: Constraints, stored: DataFrame | None = None, references: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows that break a constraint, with its name as ``constraint_name``: a row for each one that it breaks.

    Keys with a null in them are never equal, and a null refers to nothing.
    Every check is an aggregate by key and a join of equal keys.
    """
    checks = [rows.where(F.col(n).isNull()).withColumn("constraint_name", F.lit(f"not_null_{n}")) for n in c.not_null]
    for key in c.unique:
        whole = reduce(and_, [F.col(k).isNotNull() for k in key])
        twice = rows.where(whole).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
        if stored is not None:
            twice = twice.unionByName(rows.where(whole).select(*key).distinct().join(stored.select(*key), list(key), "left_semi"))
        checks.append(rows.join(twice.distinct(), list(key), "left_semi").select(*rows.columns, F.lit("unique_" + "_".join(key)).alias("constraint_name")))
    for column, (table, known) in c.foreign.items():
        there = references[table].select(F.col(known).alias(column)).distinct()
        lost = rows.where(F.col(column).isNotNull()).join(there, column, "left_anti")
        checks.append(lost.select(*rows.columns, F.lit(f"foreign_{column}").alias("constraint_name")))
    return reduce(DataFrame.unionByName, checks) if checks else rows.limit(0).withColumn("constraint_name", F.lit(""))


def insert(store: TableStore, name: str, rows: DataFrame, order: tuple[str, ...], c: Constraints | None = None) -> int:
    """Append rows to a table if they break none of its constraints, else an error that names them and nothing is stored.

    Defaults are filled in, and ids follow the highest there is, by ``order``.
    Rows are written once before they are judged, so that what is judged is
    what is stored. How many rows came.
    """
    c, schema = c or DECLARED[name], TABLES[name]
    have = store.read(name, schema)
    rows = with_defaults(rows, c)
    if c.identity:
        after = have.agg(F.max(c.identity)).first()[0] or 0
        rows = assign_ids(rows.drop(c.identity), c.identity, order, after)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in rows.columns}
    made = written(rows.withColumns(missing).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), f"insert-{name}")
    try:
        wrong = broken(made, c, have, {t: store.read(t, TABLES[t]) for t, _ in c.foreign.values()})
        counts = {r.constraint_name: r.n for r in wrong.groupBy("constraint_name").agg(F.count("*").alias("n")).orderBy("constraint_name").collect()}
        if counts:
            some = [r.asDict() for r in wrong.orderBy("constraint_name", *order).limit(20).collect()]
            shown = "; ".join(f"{r.pop('constraint_name')} {({k: v for k, v in r.items() if v is not None})}" for r in some)
            raise ConstraintError(f"{name}: {counts}; {shown}")
        store.append(name, made)
        return made.count()
    finally:
        discard(made)
