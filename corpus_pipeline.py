"""A corpus pipeline: toxic documents go, one of each near-duplicate group stays, sources are mixed, texts are encoded.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, mixing, neardup, toxicity
from tessera.llm._common import stored
from tessera.llm.q_text import TOXIC, vocabulary
from tessera.llm.queries import label_quality


def fresh(docs: DataFrame, name: str) -> str:
    """name, or a longer one where docs has such a column already."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold; rows without an id are scored like all others."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = fresh(docs, "toxicity")
    return toxicity.with_score(docs, model, out=own).where(F.col(own) < TOXIC).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, five words a shingle and a similarity of 0.8 or more."""
    found = neardup.near_duplicates(docs, words=5, share=80)
    gone = stored(found.where(~F.col("kept")).select("doc_id").distinct())
    few = gone.count() <= neardup.SENT_ROWS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; only documents it takes stay."""
    own = fresh(docs, "copies")
    taken = mixing.mix(docs, quality=label_quality(spark, sf_dir)).groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").alias(own))
    taken = stored(taken.where(F.col(own) > 0))
    few = taken.count() <= neardup.SENT_ROWS
    kept = docs.join(F.broadcast(taken) if few else taken, docs["doc_id"].eqNullSafe(taken["id"]))
    return kept.withColumn(own, F.explode(F.sequence(F.lit(1), own))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the digests of ids and decoded text."""
    return bpe.encode_digests(docs, vocabulary(), keep=("doc_id", "source"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("encoding", encode)]

#: The classifier and the tokenizer are beyond SQL; tests compare stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each from what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
