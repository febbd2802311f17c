"""Tables written to the folder that the cluster shares, to cut lineage.

A written table survives lost executors and is computed once. The folder is
the session's ``spark.checkpoint.dir``; only a session that runs on this
machine alone (tests, a laptop) may leave it unset, and then gets a temporary
folder. On a cluster that is an error.

Tables stay until ``discard`` or ``clear`` removes them, as a query's rows are
read from them after the query has returned.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SENT_BYTES = 48 << 20  # the most that a join sends to every executor; more is shuffled


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back with the same schema."""
    path = f"{_own_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, whatever it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for table in tables:
        delete(table.sparkSession, table.scratch_path)


def clear(spark: SparkSession) -> None:
    """Remove all tables that this application has written; rows of earlier queries can't be read after this."""
    delete(spark, _own_folder(spark))


def sent_if_small(table: DataFrame, each: Column) -> DataFrame:
    """A written table with a broadcast hint if its rows, of ``each`` bytes, are ``SENT_BYTES`` in all at most; else as it is."""
    size = table.agg(F.sum(each + 16)).first()[0] or 0
    return F.broadcast(table) if size <= SENT_BYTES else table.hint("merge")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator's outputs of these names replace."""
    return df.drop(*names)
