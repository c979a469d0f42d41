"""Hash-chained audit logs: building a chain per log, and checking every link in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GENESIS = "0" * 64


def link(previous: Column, payload: Column) -> Column:
    return F.sha2(F.concat(previous, F.lit("\n"), payload), 256)


def build(rows: DataFrame, log: str, order: str, payload: Column) -> DataFrame:
    """log, seq (from 1), payload, previous_hash, entry_hash.

    A chain is sequential by nature: each log is folded in one row of arrays; logs are independent.
    """
    own = rows.select(F.col(log).alias("log"), F.struct(F.col(order).alias("o"), payload.alias("p")).alias("x"))
    logs = own.groupBy("log").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    empty = F.array().cast("array<struct<seq:int,payload:string,previous_hash:string,entry_hash:string>>")
    fold = F.aggregate(
        "xs",
        F.struct(F.lit(GENESIS).alias("h"), F.lit(0).alias("n"), empty.alias("out")),
        lambda a, x: F.struct(link(a["h"], x["p"]).alias("h"), (a["n"] + 1).alias("n"), F.concat(a["out"], F.array(F.struct((a["n"] + 1).alias("seq"), x["p"].alias("payload"), a["h"].alias("previous_hash"), link(a["h"], x["p"]).alias("entry_hash")))).alias("out")),
    )
    return logs.select("log", F.explode(fold["out"]).alias("e")).select("log", "e.*")


def verify(entries: DataFrame) -> DataFrame:
    """log, seq, problem: wrong numbers, links that don't match the entry before, contents that don't match their hash."""
    w = Window.partitionBy("log").orderBy("line")
    e = entries.withColumn("_i", F.row_number().over(w)).withColumn("_prev", F.lag("entry_hash", 1, GENESIS).over(w))
    each = F.array(
        F.when(F.col("seq") != F.col("_i"), F.lit("sequence")),
        F.when(F.col("previous_hash") != F.col("_prev"), F.lit("previous_hash")),
        F.when(F.col("entry_hash") != link(F.col("previous_hash"), F.col("payload")), F.lit("contents")),
    )
    return e.select("log", "seq", F.explode(F.array_compact(each)).alias("problem"))


def truncated(entries: DataFrame, heads: DataFrame) -> DataFrame:
    """log: logs whose last entry isn't the head that was expected (log, head): a cut tail breaks no link."""
    last = entries.groupBy("log").agg(F.max_by("entry_hash", "line").alias("_h"))
    return heads.join(last, "log", "left").where(~F.col("head").eqNullSafe(F.col("_h"))).select("log")
