"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source's target is a water level over the weights, capped at a multiple of the source's size. A
source is taken in complete epochs first; for the rest of its target its documents are ordered by
exponential keys -ln(u)/quality (smallest first; u is a hash of the id) and taken while the running sum
of sizes stays within it. The running sum is split: sums by (source, key bucket) give each bucket's
start, rows are then summed inside their bucket only, so a source of any size spreads over many tasks.
There are as many buckets as keep those of the largest possible source at BUCKET_ROWS rows. Texts are read
once: what the plan needs of a row is stored without its text.

Defined cases: a null text has size 0; a document of size 0 is taken never and costs nothing; a null
source is a source of its own; null or non-positive quality counts as 1; repeated ids share a key and
are ordered by size and text hash; a null id has a key of its text; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Least number of key buckets that a source's running sum is cut into, and rows of a bucket if one source held all.
BUCKETS = 256
BUCKET_ROWS = 50_000
#: md5 digits of the seeded id that make u: 13 hex digits are 52 bits, exact in a double.
DIGITS = 13


def word_count(text: Column) -> Column:
    """How many runs of other than ASCII white space a text has; null: 0."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """source, source_size, target from a row per source: the budget is the sum of all sizes.

    weights repeat over sources in code point order, null last. With level t a source gets
    min(cap * size, t * weight); t is found in one ordered pass: sources fill up in order of size / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("_level", (F.sum("source_size").over(every) - before) / rest)
    s = s.withColumn("_t", F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(every))
    return s.select("source", "source_size", F.coalesce(F.least("_cap", F.col("_t") * F.col("_w")), F.col("_cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: DataFrame | None = None, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: str = "mix", buckets: int | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken for each row of docs.

    quality: (doc_id, weight), at most a row per id. copies: how often the mix repeats the document;
    taken = copies * size. Reruns agree, whatever the partitioning.
    """
    own = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("text "), F.xxhash64(docs[text_col]).cast("string")))
    rows = docs.select(docs[id_col].alias("doc_id"), word_count(docs[text_col]).alias("size"), docs[source_col].cast("string").alias("source"), F.xxhash64(docs[text_col]).alias("_tie"), F.concat(F.lit(f"{seed}:"), own).alias("_name"))
    rows = stored(rows)
    buckets = buckets or max(BUCKETS, -(-rows.count() // BUCKET_ROWS))
    if quality is not None:
        q = quality.select(quality[quality.columns[0]].alias("doc_id"), quality[quality.columns[1]].cast("double").alias("_q"))
        rows = rows.join(q, "doc_id", "left")
    else:
        rows = rows.withColumn("_q", F.lit(1.0))
    u = (F.conv(F.substring(F.md5("_name"), 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    q = F.when(F.col("_q") > 0, F.col("_q")).otherwise(1.0)
    rows = rows.withColumn("_key", -F.log(u) / q)
    # 1 - exp(-key) is near uniform, so buckets are near even; it rises with the key
    rows = rows.withColumn("_b", F.least(F.floor((1 - F.exp(-F.col("_key"))) * buckets), F.lit(buckets - 1)).cast("int"))
    sums = rows.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, cap)
    before = sums.select("source", "_b", (F.sum("_sum").over(Window.partitionBy("source").orderBy("_b")) - F.col("_sum")).alias("_before"))
    meta = before.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(F.col("b.source").alias("_src"), F.col("b._b").alias("_bk"), "_before", "source_size", "target")
    inside = Window.partitionBy("source", "_b").orderBy("_key", "doc_id", "size", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_run", F.sum("size").over(inside))
    out = rows.join(meta, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_b") == F.col("_bk")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("target") - epochs * F.col("source_size")
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(epochs + F.when(F.col("_before") + F.col("_run") <= left, 1).otherwise(0))
    return out.select("doc_id", "size", "source", "source_size", "target", copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
