"""Ingest: an ordered rejection cascade, first-wins deduplication by content, routing to two outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import vocab


def reject(required: dict[str, Column], modality: Column, body_part: Column, has_pixels: Column, modalities=vocab.MODALITIES, body_parts=vocab.BODY_PARTS) -> Column:
    """struct<reason, detail> of the first rule that fails, or null: a missing tag (in the given order), the modality, a
    body part that is given and out of scope, no pixel data."""
    mod, part = F.upper(F.trim(F.coalesce(modality, F.lit("")))), F.upper(F.trim(F.coalesce(body_part, F.lit(""))))
    out = F.when(~F.coalesce(has_pixels, F.lit(False)), F.struct(F.lit("NO_PIXEL_DATA").alias("reason"), F.lit("").alias("detail")))
    said = lambda r, d: F.struct(F.lit(r).alias("reason"), d.alias("detail"))
    out = F.when((part != "") & ~part.isin(*body_parts), said("WRONG_BODY_PART", part)).otherwise(out)
    out = F.when(~mod.isin(*modalities), said("WRONG_MODALITY", F.when(mod == "", "<empty>").otherwise(mod))).otherwise(out)
    for tag, c in reversed(required.items()):
        out = F.when(F.trim(F.coalesce(c.cast("string"), F.lit(""))) == "", said("MISSING_REQUIRED_TAG", F.lit(tag))).otherwise(out)
    return out


def first_wins(df: DataFrame, digest: str, order: list[str], path: str) -> DataFrame:
    """df and first_path: null for the first row of a digest, else that row's path.

    Two aggregations with partial combine instead of a window, so a digest that most rows share stays spread.
    """
    rank = F.struct(*order)
    first = df.groupBy(digest).agg(F.min(rank).alias("_least"), F.min_by(F.col(path), rank).alias("_path")).withColumnRenamed(digest, "_digest")
    joined = df.join(first, df[digest].eqNullSafe(first["_digest"]))
    return joined.withColumn("first_path", F.when(rank != F.col("_least"), F.col("_path"))).drop("_digest", "_least", "_path")


def ingest(objects: DataFrame, rejection: Column, digest: str = "sha256", order: tuple[str, ...] = ("site_id", "source_path"), classify: Column | None = None, confident: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined). classify: struct<body_part, confidence> of objects without a body part; it comes after
    deduplication, so a copy of an object it rejects is a duplicate."""
    tried = objects.withColumn("_r", rejection)
    bad = tried.where(F.col("_r").isNotNull())
    good = first_wins(tried.where(F.col("_r").isNull()), digest, list(order), order[-1])
    why = F.when(F.col("first_path").isNotNull(), F.struct(F.lit("DUPLICATE_CONTENT").alias("reason"), F.concat(F.lit("identical to "), F.col("first_path")).alias("detail")))
    if classify is not None:
        odd = ~classify["body_part"].isin(*vocab.BODY_PARTS) & (classify["confidence"] >= confident)
        why = why.when(odd, F.struct(F.lit("BODY_PART_UNVERIFIED").alias("reason"), classify["body_part"].alias("detail")))
    good = good.withColumn("_r", why)
    accepted = good.where(F.col("_r").isNull()).drop("_r", "first_path")
    refused = bad.unionByName(good.where(F.col("_r").isNotNull()).drop("first_path"))
    return accepted, refused.select(order[-1], order[0], F.col("_r.reason").alias("reason"), F.col("_r.detail").alias("detail"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    """How many rows each key has: reasons, unmapped values, violations by kind."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def pair_by_stem(images: DataFrame, reports: DataFrame, keys: tuple[str, ...] = ("site_id", "stem")) -> DataFrame:
    """Each image with the report of its site and stem, if there is one."""
    return images.join(reports, list(keys), "left")


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key, value: the last row of each key that isn't blank."""
    return df.where(F.trim(F.coalesce(df[key], F.lit(""))) != "").groupBy(key).agg(F.max_by(value, order).alias(value))


def first_of(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """keys and the values of each group's first row: one aggregation with partial combine."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = "idx") -> DataFrame:
    """Position within the key, from 0."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
