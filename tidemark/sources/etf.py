"""Index-fund holdings: CSV or sheet rows to instruments with their universes."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DROPPED_SYMBOLS = ("", "-", "N/A", "CASH")
ACTIVE_UNIVERSES = ("SP500", "NDX100")


@dataclass(frozen=True)
class EtfFile:
    """How one fund's holdings file is laid out."""

    etf: str
    universe_code: str
    order: int
    symbol_column: str = "Ticker"
    name_column: str = "Name"
    weight_column: str = "Weight"
    skip_rows: int = 0


def parse_csv(spark: SparkSession, path: str, cfg: EtfFile) -> DataFrame:
    """Rows below ``skip_rows`` lines and a header that names the columns."""
    from tidemark.sources.listings import read_lines

    lines = read_lines(spark, path, header=0).where(F.col("line_no") >= cfg.skip_rows)
    head = lines.orderBy("line_no").select("value").first()
    if head is None:
        return spark.createDataFrame([], "symbol string, company_name string, weight_text string")
    names = [n.strip().strip('"') for n in head[0].split(",")]
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    rows = lines.where(F.col("line_no") > cfg.skip_rows).select(F.from_csv("value", schema).alias("r"))
    at = {n: F.col(f"r.c{i}") for i, n in enumerate(names)}
    pick = lambda n: at.get(n, F.lit(None).cast("string"))
    return rows.select(pick(cfg.symbol_column).alias("symbol"), pick(cfg.name_column).alias("company_name"), pick(cfg.weight_column).alias("weight_text"))


def parse_xlsx(spark: SparkSession, data: bytes, cfg: EtfFile) -> DataFrame:
    """The first sheet of a workbook, read on the driver: a holdings file has some hundred rows."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{ns['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
    table = []
    for row in sheet.iter(f"{{{ns['m']}}}row"):
        cells: dict[str, str | None] = {}
        for c in row.findall("m:c", ns):
            value = c.findtext("m:v", None, ns) if c.get("t") != "inlineStr" else "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
            cells["".join(x for x in c.get("r", "") if x.isalpha())] = shared[int(value)] if c.get("t") == "s" and value is not None else value
        table.append(cells)
    body = table[cfg.skip_rows :]
    if not body:
        return spark.createDataFrame([], "symbol string, company_name string, weight_text string")
    at = {v: k for k, v in body[0].items() if v}
    rows = [tuple(r.get(at.get(n, "")) for n in (cfg.symbol_column, cfg.name_column, cfg.weight_column)) for r in body[1:]]
    return spark.createDataFrame(rows, "symbol string, company_name string, weight_text string")


def normalise(rows: DataFrame) -> DataFrame:
    """Symbols trimmed and in capitals, placeholders dropped, ``weight_text`` as a share (null if it isn't a number)."""
    symbol = F.upper(F.trim("symbol"))
    weight = F.trim(F.replace(F.col("weight_text"), F.lit("%"), F.lit(""))).try_cast("double") / 100
    return rows.withColumns({"symbol": symbol, "weight": weight}).where(F.col("symbol").isNotNull() & ~F.col("symbol").isin(*DROPPED_SYMBOLS)).drop("weight_text")


def merge(holdings: DataFrame) -> DataFrame:
    """One row a symbol: its universes in the order of their funds, weight and name of the first fund.

    ``holdings`` carries symbol, company_name, weight, universe_code, etf_order.
    """
    first = F.min(F.struct("etf_order", "weight", "company_name"))
    codes = F.array_distinct(F.transform(F.array_sort(F.collect_set(F.struct("etf_order", "universe_code"))), lambda x: x["universe_code"]))
    made = holdings.groupBy("symbol").agg(codes.alias("universe_codes"), first.alias("f"))
    return made.select("symbol", "universe_codes", "f.weight", "f.company_name", F.arrays_overlap("universe_codes", F.array(*map(F.lit, ACTIVE_UNIVERSES))).alias("is_active"))


def union_of(frames: list[tuple[EtfFile, DataFrame]]) -> DataFrame:
    """Normalised holdings of several funds, tagged with their universe and order."""
    out = None
    for cfg, rows in frames:
        tagged = normalise(rows).withColumns({"universe_code": F.lit(cfg.universe_code), "etf_order": F.lit(cfg.order)})
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no holdings")
    return out


def load_funds(loaders: list[tuple[EtfFile, Callable[[], DataFrame]]]) -> tuple[DataFrame | None, dict[str, str]]:
    """The union of the funds that can be read, and the errors of the others by fund: one bad file costs that fund only.

    Each loader's file is read once here, a few hundred rows, so that an error shows.
    """
    frames, errors = [], {}
    for cfg, load in loaders:
        try:
            rows = load()
            rows.count()
            frames.append((cfg, rows))
        except Exception as e:  # noqa: BLE001
            errors[cfg.etf] = f"{type(e).__name__}: {e}"
    return (union_of(frames) if frames else None), errors
