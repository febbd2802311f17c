"""Chunks of a fetch: each request is a row, and a bad one costs only itself.

The planner's requests are dealt out as rows, so neither a list of them nor
what they bring passes through the driver; a run over ten thousand symbols and
ten years has a million. ``partitions`` bounds how many are asked for at once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Gives the payloads of a chunk, as dicts or JSON texts: symbol, first day, last day, interval. An error fails the chunk.
Fetch = Callable[[str, date, date, str], Iterable["dict | str"]]
FIELDS = ("symbol", "interval", "chunk", "chunk_start", "chunk_end", "line", "error")
SCHEMA = "symbol string, interval string, chunk int, chunk_start date, chunk_end date, line string, error string"
ROWS = 4096  # of an Arrow batch
_KINDS = [pa.string(), pa.string(), pa.int32(), pa.date32(), pa.date32(), pa.string(), pa.string()]
_ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}  # fixed values: as Spark escapes them in folder names


def _payloads(fetch: Fetch, row: dict) -> list[str]:
    """All of a chunk or none: what comes must be JSON objects, one each."""
    out = []
    for n, payload in enumerate(fetch(row["symbol"], row["chunk_start"], row["chunk_end"], row["interval"]), 1):
        if isinstance(payload, str):
            if not payload.strip():
                continue
            try:
                if not isinstance(json.loads(payload), dict):
                    raise ValueError("not an object")
            except ValueError as e:
                raise ValueError(f"line {n}: {e}") from None
        out.append(payload if isinstance(payload, str) else json.dumps(payload, default=str))
    return out


def fetch_chunks(requests: DataFrame, fetch: Fetch, intervals: tuple[str, ...] = ("1d",), partitions: int | None = None) -> DataFrame:
    """(symbol, interval, chunk, chunk_start, chunk_end, line, error): the payloads of every requested chunk, or its error.

    ``requests`` are the planner's chunks. A chunk that fails on the way gives
    one row with an error and no payload; the others go on. An empty chunk
    gives no row. Nothing is asked for twice as long as the result is written
    once; ``fetch`` runs on the executors.
    """
    spark = requests.sparkSession
    asked = requests.select("symbol", F.explode(F.array(*map(F.lit, intervals))).alias("interval"), "chunk", "chunk_start", "chunk_end")
    dealt = asked.repartition(partitions or spark.sparkContext.defaultParallelism, "symbol", "interval", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)], names=list(FIELDS))

        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[f] for f in FIELDS[:5])
                try:
                    out += [(*own, line, None) for line in _payloads(fetch, row)]
                except Exception as e:  # noqa: BLE001 - whatever a provider raises fails its chunk alone
                    out.append((*own, None, f"{type(e).__name__}: {e}"))
                if len(out) >= ROWS:
                    yield passed_on()
                    out.clear()
        if out:
            yield passed_on()

    return dealt.mapInArrow(run, SCHEMA)


def failed_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.where("error is not null").drop("line")


def in_chunk(day: Column) -> Column:
    """Whether a bar's day lies in the chunk that it came with."""
    return day.between(F.col("chunk_start"), F.col("chunk_end"))


@dataclass(frozen=True)
class ChunkFiles:
    """Chunks landed as ``<root>/interval=<i>/symbol=<s>/chunk_start=<day>/``, JSON lines in any number of files.

    A folder that isn't there is a chunk that didn't land: an error, unless
    ``missing_ok``. The root may be a path or an address that pyarrow reads.
    """

    root: str
    missing_ok: bool = False

    def _open(self):
        from pyarrow import fs

        if self.root.startswith("file:"):
            return fs.LocalFileSystem(), "/" + self.root.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)

    def __call__(self, symbol: str, start: date, end: date, interval: str) -> Iterator[str]:
        from pyarrow import fs

        files, root = self._open()
        folder = f"{root}/interval={escaped(interval)}/symbol={escaped(symbol)}/chunk_start={start}"
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        if not found and files.get_file_info(folder).type == fs.FileType.NotFound and not self.missing_ok:
            raise FileNotFoundError(f"no chunk of {symbol} at {start}")
        for info in sorted(found, key=lambda f: f.path):
            if info.is_file and not info.base_name.startswith(("_", ".")):
                with files.open_input_stream(info.path) as f:
                    yield from f.read().decode().splitlines()

    def healthy(self, spark: SparkSession) -> bool:
        from pyarrow import fs

        files, root = self._open()
        return files.get_file_info(root).type == fs.FileType.Directory


def escaped(name: str) -> str:
    """A value as a folder name, as Spark writes it."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in name)


def land(lines: DataFrame, root: str) -> None:
    """Write (symbol, interval, chunk_start, line) as ``ChunkFiles`` reads them; a null or blank line lands an empty chunk."""
    rows = lines.select("interval", "symbol", "chunk_start", F.coalesce("line", F.lit("")).alias("value"))
    rows.repartition("interval", "symbol", "chunk_start").write.partitionBy("interval", "symbol", "chunk_start").text(root)
