"""Control tables: commands, batch groups, run log, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What each command does to a feed.
EFFECTS = {"FORCE_RELOAD": "reload", "HISTORY_LOAD": "extend", "PAUSE": "paused", "RESUME": "active", "SKIP_ONCE": "skip"}


def command_effects(feed: DataFrame, commands: DataFrame) -> DataFrame:
    """Each feed's effect of its oldest pending command, if it has one."""
    first = commands.where("status = 'PENDING'").groupBy("instrument_id").agg(F.min(F.struct("command_id", "command")).alias("c"))
    effect = F.element_at(F.create_map(*[F.lit(x) for kv in EFFECTS.items() for x in kv]), F.col("c.command"))
    default = F.when(F.col("is_active"), "active").otherwise("paused")
    return feed.join(first, "instrument_id", "left").select("instrument_id", F.col("c.command_id").alias("command_id"), F.when(F.col("c").isNull(), default).otherwise(effect).alias("effect"))


def consume(commands: DataFrame, effects: DataFrame, now: Column) -> DataFrame:
    """Commands with those that took effect marked done, once."""
    used = effects.where("command_id is not null").select("command_id", F.lit(True).alias("__used"))
    out = commands.join(used, "command_id", "left")
    return out.withColumns({"status": F.when(F.col("__used"), "DONE").otherwise(F.col("status")), "consumed_at": F.when(F.col("__used"), now).otherwise(F.col("consumed_at"))}).drop("__used").select(*commands.columns)


def batch_scope(feed: DataFrame, batches: DataFrame) -> DataFrame:
    """Feeds that each batch runs: those of its groups, the first ``max_symbols_per_run`` by priority."""
    joined = batches.where("is_active").join(feed.where("is_active"), F.array_contains(F.split("groups", ","), F.col("batch_group")))
    place = F.row_number().over(W.partitionBy("job_type").orderBy("priority", "instrument_id"))
    return joined.withColumn("place", place).where("max_symbols_per_run is null or place <= max_symbols_per_run").select("job_type", "batch_group", "instrument_id", "priority", "place")


def last_success(log: DataFrame) -> DataFrame:
    return log.where("status = 'success'").groupBy("instrument_id").agg(F.max("completed_at").alias("last_success"))


def failed_since(log: DataFrame, today: Column, days: int = 7) -> DataFrame:
    return log.where((F.col("status") != "success") & (F.col("completed_at") >= F.date_sub(today, days)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row for each table."""
    out = None
    for name, df in tables.items():
        each = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = each if out is None else out.unionByName(each)
    return out


def violations(df: DataFrame, not_null: tuple[str, ...] = (), unique: tuple[str, ...] = ()) -> DataFrame:
    """(constraint_name, violations): what table constraints would refuse."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]) if not_null else None
    out = None
    if nulls is not None:
        out = nulls.select(F.explode(F.array(*[F.struct(F.lit(f"not_null_{c}").alias("constraint_name"), F.col(c).alias("violations")) for c in not_null])).alias("x")).select("x.*")
    if unique:
        twice = df.groupBy(*unique).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("violations"))
        twice = twice.select(F.lit("unique_" + "_".join(unique)).alias("constraint_name"), "violations")
        out = twice if out is None else out.unionByName(twice)
    return out
