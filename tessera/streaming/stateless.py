"""Streams: the row-wise operators run on them as they are; deduplication keeps state under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions import identity
from tessera.operators import splits


def read_parquet_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def pseudonymised(stream: DataFrame, key: bytes, patient: str, salt: str) -> DataFrame:
    """stream with a pseudonym in place of the patient, and the patient's split."""
    pid = F.substring(identity.mac(key, "patient-national", identity.normalise_identifier(F.col(patient).cast("string"))), 1, 16)
    return stream.withColumn("pseudo_id", pid).withColumn("split", splits.assign(F.col("pseudo_id"), salt)).drop(patient)


def first_seen(stream: DataFrame, digest: str, at: str, delay: str = "1 day") -> DataFrame:
    """The first row of each digest within the watermark's delay; state is bounded by it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([digest])


def counts_by_window(stream: DataFrame, at: str, key: str, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, width).alias("window"), key).agg(F.count("*").alias("n"))


def run_available(out: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes all that is there now and stops."""
    q = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
