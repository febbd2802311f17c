"""Symbol directory files: pipe-delimited lines to instruments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Exchange codes of the listing files and their market identifier codes.
EXCHANGE_MIC = {"A": "XASE", "N": "XNYS", "P": "ARCX", "Z": "BATS", "V": "IEXG", "Q": "XNAS"}
# A name that contains one of these isn't common stock or a fund.
EXCLUDED = (
    " warrant", " warrants", " right", " rights", " unit", " units",
    " preferred", " pfd", " note", " notes", " bond", " debenture",
    "test", " acquisition", " spac",
)
TRAILER = "File Creation Time"


def is_excluded(name: Column, symbol: Column) -> Column:
    """Whether a line is left out; one pattern, so that the stage's code stays small."""
    return F.endswith(symbol, F.lit("$")) | F.lower(name).rlike("|".join(re.escape(part) for part in EXCLUDED))


def exchange_mic(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in EXCHANGE_MIC.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def asset_class(flag: Column) -> Column:
    return F.when(F.upper(F.trim(flag)) == "Y", "etf").otherwise("equity")


def _fields(lines: DataFrame, line: str) -> DataFrame:
    trimmed = F.trim(F.col(line))
    parts = F.split(trimmed, r"\|")
    kept = lines.withColumn("__p", F.when((trimmed != "") & ~F.startswith(trimmed, F.lit(TRAILER)), parts))
    return kept.where("size(__p) >= 7")


def _part(i: int) -> Column:
    return F.trim(F.get("__p", F.lit(i)))


def parse_nasdaq(lines: DataFrame, line: str = "value") -> DataFrame:
    """Instruments of the first directory file; header lines are to be left out. Other columns stay."""
    made = _fields(lines, line).where((F.upper(_part(3)) != "Y") & ~is_excluded(_part(1), _part(0)))
    columns = {"symbol": _part(0), "company_name": _part(1), "asset_class": asset_class(_part(6)), "exchange": F.lit("NASDAQ"), "exchange_mic": F.lit("XNAS"), "currency": F.lit("USD")}
    return made.withColumns(columns).drop("__p", line)


def parse_other(lines: DataFrame, line: str = "value") -> DataFrame:
    """Instruments of the second directory file, whose fields stand elsewhere."""
    made = _fields(lines, line).where((F.upper(_part(6)) != "Y") & ~is_excluded(_part(1), _part(0)))
    columns = {"symbol": _part(0), "company_name": _part(1), "asset_class": asset_class(_part(4)), "exchange": _part(2), "exchange_mic": exchange_mic(_part(2)), "currency": F.lit("USD")}
    return made.withColumns(columns).drop("__p", line)


def merge(nasdaq: DataFrame, other: DataFrame) -> DataFrame:
    """One row a symbol: the first file wins; in it a symbol's last line counts, in the other its first.

    Both frames carry ``line_no``.
    """
    both = nasdaq.withColumn("source_rank", F.lit(0)).withColumn("__o", -F.col("line_no")).unionByName(other.withColumn("source_rank", F.lit(1)).withColumn("__o", F.col("line_no")))
    first = W.partitionBy("symbol").orderBy("source_rank", "__o")
    return both.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__o", "line_no")


def read_lines(spark, path: str, header: int = 1) -> DataFrame:
    """(line_no, value) of a small directory file as it was landed, without its header."""
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))
    return text.where((F.col("line_no") >= header) & (F.col("value") != ""))
