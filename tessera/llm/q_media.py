"""The query of the media operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tiff

UNIT = 64


def op7_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    n = F.octet_length(raw)
    goal = F.greatest(F.lit(UNIT), F.ceil(n / UNIT).cast("int") * UNIT)
    rows = docs.select("doc_id", raw.alias("raw"), n.cast("long").alias("n_bytes"), goal.alias("goal"))
    # at most UNIT zero bytes are missing
    rows = rows.select("doc_id", "n_bytes", F.concat("raw", F.substring(F.lit(bytearray(UNIT)), F.lit(1), (F.col("goal") - F.col("n_bytes")).cast("int"))).alias("payload"))
    files = tiff.store_bytes(rows, "payload", ("doc_id", "n_bytes"), width=UNIT)
    files = files.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    pages = tiff.read_pages(files, "media", keep=("doc_id", "n_bytes", "media_bytes", "media_sha256"))
    return pages.select(
        "doc_id",
        "n_bytes",
        F.octet_length("pixels").cast("long").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.substring("pixels", -UNIT, UNIT)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
    )
