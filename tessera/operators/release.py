"""Releases: content-addressed manifests, their digest, checks, and a role's view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest(images: DataFrame, reports: DataFrame) -> DataFrame:
    """path, sha256, size_bytes, sop_uid, study_uid: images have the first id, reports the second."""
    return images.unionByName(reports, allowMissingColumns=True)


def entry_json(*columns: str) -> Column:
    """Canonical JSON of a row: keys in order, nulls dropped, no spaces; values must be ASCII."""
    return F.to_json(F.struct(*sorted(columns)))


def digest(rows: DataFrame, columns: list[str], path: str = "path", groups: int | None = None) -> DataFrame:
    """n, digest: sha256 of the canonical JSON array ordered by path.

    The array is one string: what is aggregated grows with the manifest. digest_tree scales further.
    """
    j = rows.select(F.col(path).alias("_p"), entry_json(*columns).alias("_j"))
    return j.agg(F.count("*").alias("n"), F.sha2(F.concat(F.lit("["), F.coalesce(F.expr("listagg(_j, ',') WITHIN GROUP (ORDER BY _p, _j)"), F.lit("")), F.lit("]")), 256).alias("digest"))


def digest_tree(rows: DataFrame, columns: list[str], path: str = "path", digits: int = 2) -> DataFrame:
    """n, digest: sha256 over the digests of parts, by the first hex digits of each path's sha256: no task has all rows."""
    j = rows.select(F.substring(F.sha2(F.col(path), 256), 1, digits).alias("_g"), F.col(path).alias("_p"), entry_json(*columns).alias("_j"))
    parts = j.groupBy("_g").agg(F.count("*").alias("n"), F.sha2(F.expr("listagg(_j, ',') WITHIN GROUP (ORDER BY _p, _j)"), 256).alias("d"))
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.sha2(F.coalesce(F.expr("listagg(_g || d, ',') WITHIN GROUP (ORDER BY _g)"), F.lit("")), 256).alias("digest"))


def verify_files(entries: DataFrame, files: DataFrame) -> DataFrame:
    """path, problem: entries without a file, with another content, and files without an entry."""
    a, b = entries.select("path", F.col("sha256").alias("_want")), files.select("path", F.col("sha256").alias("_have"))
    j = a.join(b, "path", "full_outer")
    problem = F.when(F.col("_have").isNull(), "missing").when(F.col("_want").isNull(), "unlisted").when(F.col("_want") != F.col("_have"), "changed")
    return j.select("path", problem.alias("problem")).where("problem IS NOT NULL")
