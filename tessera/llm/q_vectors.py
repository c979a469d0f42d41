"""The query of the vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import hnsw


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), is_query="id % 20 = 0", k=20)
