"""Equity: strata, prevalence parity, weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import age_band

FEWEST = 30
CAP = 10.0


def stratum_key(site: Column, sex: Column, age: Column) -> Column:
    return F.concat_ws(" | ", site, F.coalesce(sex, F.lit("U")), age_band(age))


def strata(studies: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """stratum, n_patients, n_studies from studies (study, patient, stratum)."""
    return studies.groupBy("stratum").agg(F.count_distinct("patient").alias("n_patients"), F.count_distinct("study").alias("n_studies"))


def prevalence(studies: DataFrame, labels: DataFrame, findings: list[str]) -> DataFrame:
    """stratum, n_studies, finding, n, rate: distinct studies with a finding; a finding no study has is 0."""
    size = studies.groupBy("stratum").agg(F.count_distinct("study").alias("n_studies"))
    has = studies.select("study", "stratum").distinct().join(labels.select("study", "finding").distinct(), "study").groupBy("stratum", "finding").agg(F.count("*").alias("n"))
    grid = size.withColumn("finding", F.explode(F.array(*map(F.lit, findings)).cast("array<string>")))
    return grid.join(has, ["stratum", "finding"], "left").select("stratum", "n_studies", "finding", F.coalesce("n", F.lit(0)).cast("long").alias("n"), (F.coalesce("n", F.lit(0)) / F.col("n_studies")).alias("rate"))


def parity_gaps(rates: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """finding, gap, high, low over strata of enough studies, where there are two; equal rates: the larger, then first, stratum."""
    big = rates.where(F.col("n_studies") >= fewest)
    # order by rate, then size, then name: the negated size and a name compare the same way for both ends
    place = F.struct((-F.col("n_studies")).alias("o"), "stratum")
    got = big.groupBy("finding").agg(F.count("*").alias("k"), F.max("rate").alias("hi"), F.min("rate").alias("lo"))
    ends = big.join(got.where("k >= 2"), "finding")
    return ends.groupBy("finding", "hi", "lo").agg(F.min(F.when(F.col("rate") == F.col("hi"), place)).alias("h"), F.min(F.when(F.col("rate") == F.col("lo"), place)).alias("l")).select("finding", (F.col("hi") - F.col("lo")).alias("gap"), F.col("h.stratum").alias("high"), F.col("l.stratum").alias("low"))


def weights(counts: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """stratum, weight, capped, was_capped: (target / all targets) / (n / all n); a stratum without target weighs 0; empty ones go."""
    both = counts.where("n > 0").join(targets, "stratum", "left").withColumn("target", F.coalesce("target", F.lit(0.0)))
    sums = both.agg(F.sum("n").alias("_n")).crossJoin(targets.agg(F.sum("target").alias("_t")))  # one row
    t = F.when(F.col("_t") > 0, F.col("_t")).otherwise(F.raise_error("targets must have a positive sum").cast("double"))
    w = (F.col("target") / t) / (F.col("n") / F.col("_n"))
    return both.join(F.broadcast(sums)).select("stratum", w.alias("weight"), F.least(w, F.lit(cap)).alias("capped"), (w > cap).alias("was_capped"))
