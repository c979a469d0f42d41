"""Agreement of labels with a reference: contingency tables, kappa, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPORT = 30


def contingency(pairs: DataFrame, keys: list[str], predicted: Column, truth: Column) -> DataFrame:
    """keys, tp, fp, fn, tn."""
    p, t = F.coalesce(predicted, F.lit(False)), F.coalesce(truth, F.lit(False))
    return pairs.groupBy(*keys).agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))


def with_total(table: DataFrame, key: str, total: str = "pooled") -> DataFrame:
    """A table by key and, from the same pass, the sum of its cells over all keys."""
    return table.rollup(key).agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn", "tn")]).withColumn(key, F.when(F.col(key).isNull(), F.lit(total)).otherwise(F.col(key)))


def kappa(table: DataFrame) -> DataFrame:
    """table, observed, expected, kappa, support, prevalence, band."""
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    po = F.when(n > 0, (F.col("tp") + F.col("tn")) / n).otherwise(0.0)
    pe = F.when(n > 0, ((F.col("tp") + F.col("fp")) * (F.col("tp") + F.col("fn")) + (F.col("fn") + F.col("tn")) * (F.col("fp") + F.col("tn"))) / (n * n)).otherwise(0.0)
    out = table.withColumn("observed", po).withColumn("expected", pe)
    k = F.when((n > 0) & (F.col("expected") < 1), (F.col("observed") - F.col("expected")) / (1 - F.col("expected"))).otherwise(0.0)
    out = out.withColumn("kappa", k).withColumn("support", F.col("tp") + F.col("fn")).withColumn("prevalence", F.when(n > 0, F.col("support") / n).otherwise(0.0))
    return out.withColumn("band", band(F.col("kappa"), F.col("support")))


def band(k: Column, support: Column) -> Column:
    out = F.when(support < SUPPORT, "insufficient support")
    for least, name in ((0.81, "almost perfect"), (0.61, "substantial"), (0.41, "moderate"), (0.21, "fair"), (0.01, "slight")):
        out = out.when(k >= least, name)
    return out.otherwise("poor")


def scores(table: DataFrame) -> DataFrame:
    """table, precision, recall, f1; 0 where a denominator is 0."""
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = div(F.col("tp"), F.col("tp") + F.col("fp")), div(F.col("tp"), F.col("tp") + F.col("fn"))
    return table.withColumn("precision", p).withColumn("recall", r).withColumn("f1", div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def label_pairs(predicted: DataFrame, reference: DataFrame, doc: str, labels: list[str]) -> DataFrame:
    """doc, label, p, t of two tables (doc, set): both must hold the same documents."""
    both = predicted.select(doc, F.col("labels").alias("_p")).join(reference.select(doc, F.col("labels").alias("_t")), doc, "full_outer")
    ok = F.when(F.col("_p").isNull() | F.col("_t").isNull(), F.raise_error(F.concat(F.lit("only one side has document "), F.col(doc).cast("string"))).cast("boolean")).otherwise(True)
    return both.where(ok).select(doc, F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.array_contains("_p", x).alias("p"), F.array_contains("_t", x).alias("t")) for x in labels])).alias("x")).select(doc, "x.*")


def upper_median(values: Column) -> Column:
    """The middle value, the upper of two."""
    return F.element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))
