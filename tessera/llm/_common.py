"""Pieces the operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(1)
def _local_dir() -> str:
    """A folder of this process, gone when it ends; for one machine only."""
    path = tempfile.mkdtemp(prefix="tessera-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; where it names none and all runs in one process, a local one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is unset on a cluster")
    return _local_dir()


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes tables that stored() wrote and nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        for f in df.inputFiles()[:1]:
            p = jvm.org.apache.hadoop.fs.Path(f).getParent()
            if p.getName().startswith("t-"):
                p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def own(df: DataFrame, **columns: str) -> DataFrame:
    """df's columns that an operator reads, under the operator's names; all others go, so none can clash."""
    return df.select(*[df[c].alias(n) for n, c in columns.items()])
