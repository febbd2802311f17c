"""Parquet tables: append, and replacement by a new version beside the old.

``name/v=<n>`` holds version n. Readers use the last version whose write was
committed (its ``_SUCCESS`` file comes last), so they see either the old table
or the new, also if a job dies on the way. Appends go into the current version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import TABLES


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _version(self, name: str) -> int:
        """The last committed version, -1 without one."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return -1
        found = [str(f.getPath().getName()) for f in fs.listStatus(p)]
        numbers = sorted((int(n[2:]) for n in found if n.startswith("v=")), reverse=True)
        return next((v for v in numbers if fs.exists(self._fs(f"{self.root}/{name}/v={v}/_SUCCESS")[1])), -1)

    def exists(self, name: str) -> bool:
        return self._version(name) >= 0

    def path(self, name: str) -> str:
        if (v := self._version(name)) < 0:
            raise FileNotFoundError(f"no table {name}")
        return f"{self.root}/{name}/v={v}"

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; if it doesn't exist and a schema is given, an empty one."""
        if schema is not None and not self.exists(name):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def append(self, name: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        if not self.exists(name):
            self.replace(name, rows, partition_by)
        else:
            rows.write.mode("append").partitionBy(*partition_by).parquet(self.path(name))

    def replace(self, name: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Write the next version; ``rows`` may read the current one."""
        version = self._version(name) + 1
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{name}/v={version}")

    def replace_partitions(self, name: str, rows: DataFrame, partition_by: tuple[str, ...]) -> None:
        """Replace those partitions of the current version that ``rows`` has rows for; all others stay as they are.

        ``rows`` may not read this table. Partitions are replaced together when
        the job commits; a job that is run again writes the same.
        """
        if not self.exists(name):
            self.replace(name, rows, partition_by)
        else:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(self.path(name))

    def create(self, name: str, schema: T.StructType) -> bool:
        """An empty table of this schema, unless there is one; whether it made one."""
        if self.exists(name):
            return False
        self.replace(name, self.spark.createDataFrame([], schema))
        return True

    def create_all(self) -> list[str]:
        """All reference and control tables that don't exist yet; their names."""
        return [n for n, schema in TABLES.items() if self.create(n, schema)]

    def seed(self, name: str, rows: DataFrame) -> bool:
        """Write ``rows`` only where the table has none; whether it did."""
        if self.exists(name) and not self.read(name).isEmpty():
            return False
        self.replace(name, rows)
        return True
