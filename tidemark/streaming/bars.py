"""Bars from a stream of ticks, and ingestion of a stream of bars batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Stream
from tidemark import schemas as S
from tidemark.plans.job import ingest_batch, months_of, refresh_silver
from tidemark.store import TableStore

WIDTH = {"1h": "1 hour", "4h": "4 hours", "15m": "15 minutes", "5m": "5 minutes", "1m": "1 minute"}


def bars_from_ticks(ticks: DataFrame, interval: str = "1h", late: str = "10 minutes") -> DataFrame:
    """Open, high, low, close and volume of each symbol and window; works on streams and tables alike.

    ``ticks``: symbol, ts, value. Ticks later than ``late`` are dropped by the
    stream; ticks of the same time are ordered by value.
    """
    timed = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if ticks.isStreaming else timed
    order = F.struct("ts", "value")
    made = timed.groupBy("symbol", F.window("ts", WIDTH[interval]).alias("w")).agg(
        F.min(order).alias("first"), F.max("value").alias("high"), F.min("value").alias("low"), F.max(order).alias("last"), F.count("*").alias("volume")
    )
    return made.select("symbol", F.col("w.start").alias("bar_time"), F.lit(interval).alias("interval"), F.col("first.value").alias("open"), "high", "low", F.col("last.value").alias("close"), "volume")


def ingest_stream(bars: DataFrame, store: TableStore, stream: Stream, checkpoint: str, version: str = "unknown") -> StreamingQuery:
    """Feed a stream of bars to the same ingestion as batches; a batch that is replayed adds nothing twice."""

    def each(batch: DataFrame, number: int) -> None:
        ingest_batch(store, batch, stream, f"batch_{stream.name}_{number}", version).discard()

    return bars.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(store: TableStore, table: str, silver: str, counts: str, checkpoint: str, files: int | None = None) -> StreamingQuery:
    """Feed what is appended to a table of bars to its latest versions, and to counts of what came in.

    The stream reads each appended file once; ``files`` bounds how many a
    micro-batch takes. A micro-batch names the months to be brought up to date
    and counts its rows by batch and interval under its own number, so that one
    that is replayed replaces what it wrote. However the files are cut into
    micro-batches, also by a late start, the tables come out the same but for
    that number. Ends when all files are read; start it again for more.
    """
    schema = S.T.StructType([*S.BARS_SCHEMA.fields, S.T.StructField("month", S.T.StringType())])
    reader = store.spark.readStream.schema(schema)
    reader = reader if files is None else reader.option("maxFilesPerTrigger", files)

    def each(batch: DataFrame, number: int) -> None:
        months = months_of(batch)
        refresh_silver(store, table, silver, months)
        came = batch.groupBy("batch_id", "interval").agg(F.count("*").alias("n_bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        if months:
            store.replace_partitions(counts, came.withColumn("micro_batch", F.lit(number)), ("micro_batch",))

    query = reader.parquet(store.path(table)).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def change_counts(store: TableStore, counts: str) -> DataFrame:
    """What came in, by batch and interval, over all micro-batches."""
    each = store.read(counts).groupBy("batch_id", "interval")
    return each.agg(F.sum("n_bars").alias("n_bars"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
