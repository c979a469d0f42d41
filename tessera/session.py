"""Session construction and fixture loading."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tessera", cpus: str | None = None, memory: str = "12g", shuffle: int | None = None) -> SparkSession:
    """A local session with the settings the engine is tuned for; a running session is reused."""
    n = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle or n))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture table, read by Spark only: the path may be in any store Spark knows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
