"""Session builder and the shared scratch area."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with ANSI, UTC and adaptive execution on; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
    } | conf
    return SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=settings).getOrCreate()
