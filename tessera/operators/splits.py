"""Splits by hash thresholds: a patient's split depends on its id and salt alone, so growth moves nobody."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions.identity import BUCKETS, UNIT, split_bucket

RATIOS = (0.8, 0.1, 0.1)


def assign(key: Column, salt: Column | str, ratios: tuple[float, float, float] = RATIOS) -> Column:
    if any(r < 0 for r in ratios) or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("ratios must not be negative and sum to 1")
    b = split_bucket(salt, key)
    train, val = int(ratios[0] * BUCKETS), int(ratios[1] * BUCKETS)
    return F.when(b < train, "train").when(b < train + val, "val").otherwise("test")


def assign_stratified(key: Column, stratum: Column, salt: str, ratios: tuple[float, float, float] = RATIOS) -> Column:
    return assign(key, F.concat(F.lit(salt + UNIT), stratum), ratios)


def proportions(assigned: DataFrame, split: str = "split") -> DataFrame:
    """split, n, share: always all three splits."""
    base = assigned.sparkSession.createDataFrame([(s,) for s in vocab.SPLITS], "split string")
    n = assigned.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("n"))
    every = base.join(n, "split", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = n.agg(F.sum("n").alias("_t"))
    return every.join(F.broadcast(total)).select("split", F.col("n").cast("long").alias("n"), F.when(F.col("_t") > 0, F.col("n") / F.col("_t")).otherwise(0.0).alias("share"))


def churn(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """n, moved: of the keys assigned before, how many have another split after."""
    both = before.select(key, F.col("split").alias("_a")).join(after.select(key, F.col("split").alias("_b")), key)
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("_a") != F.col("_b")).alias("moved"))
