"""The queries of the classifier, the extractor and the tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, html_text, lm, neardup, toxicity

#: A vocabulary file of a public tokenizer; the path is a parameter.
VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe.encode_digests(docs, vocabulary())


#: A text is toxic from this score on.
TOXIC = 0.3


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.pmod(F.crc32(F.encode(docs["doc_id"].cast("string"), "UTF-8")), F.lit(10)) == 0, F.lit(False))
    return lm.score(docs, held)


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, share=80)
