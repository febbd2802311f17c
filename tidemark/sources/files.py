"""Seed files, and landing of raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The ticker seed with types; what doesn't parse is null, a row without symbol is left out."""
    raw = spark.read.schema(S.TICKER_SCHEMA).csv(path, header=True, mode="PERMISSIVE")
    text = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    made = raw.select(*map(text, raw.columns))
    day = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
    columns = {
        "symbol": F.upper("symbol"), "active": F.lower(F.coalesce("active", F.lit("true"))).isin("true", "1", "yes", "y"), "min_price": F.col("min_price").try_cast("double"),
        "added_date": day("added_date"), "history_start": day("history_start"), "ipo_date": day("ipo_date"),
    }
    return made.where("symbol is not null").withColumns(columns)


def read_strategies(spark: SparkSession, path: str) -> DataFrame:
    """The strategy seed, its indicators as a list."""
    raw = spark.read.csv(path, header=True)
    return raw.withColumn("entry_indicators", F.transform(F.split("entry_indicators", ","), lambda x: F.trim(x)))


def land_text(lines: DataFrame, root: str, source: str, day: str) -> str:
    """Keep a source's lines as they came, before anything parses them; the path they went to."""
    path = f"{root.rstrip('/')}/reference/{source}/{day}"
    lines.select(F.col("value").cast("string")).write.mode("overwrite").text(path)
    return path


def land_bytes(spark: SparkSession, data: bytes, root: str, source: str, day: str, name: str) -> str:
    """Keep a binary file (a workbook) as it came; the path it went to."""
    path = f"{root.rstrip('/')}/reference/{source}/{day}/{name}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()
    return path
