"""Harmonise: facts, reports and sidecars become canonical tables; what no rule maps is counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.mapping import RuleSet, by_site, is_unmapped
from tessera.operators import ingest


def require_sites(df: DataFrame, rules: dict[str, RuleSet], site: str = "site_id") -> DataFrame:
    """df; a row of a site without rules fails the query with the file to add."""
    known = F.col(site).isin(*rules)
    return df.where(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no configuration for site; add configs/sites/"), F.lower(F.coalesce(F.col(site), F.lit("null"))), F.lit(".yaml"))).cast("boolean")))


def resolve_column(df: DataFrame, column: str, rules: dict[str, RuleSet], out: str, site: str = "site_id") -> DataFrame:
    """df, out (the canonical value) and out_unmapped."""
    got = by_site(F.col(site), rules, F.col(column))
    return df.withColumn(f"_{out}", got).withColumn(out, F.col(f"_{out}.value")).withColumn(f"{out}_unmapped", is_unmapped(F.col(f"_{out}"), F.col(column))).drop(f"_{out}")


def unmapped(df: DataFrame, fields: dict[str, str], site: str = "site_id") -> DataFrame:
    """site_id, field, value, n: by field, the trimmed native values that no rule maps. fields: canonical -> native column."""
    each = F.array(*[F.when(F.col(f"{c}_unmapped"), F.struct(F.lit(c).alias("field"), F.trim(F.col(native)).alias("value"))) for c, native in fields.items()])
    rows = df.select(F.col(site).alias("site_id"), F.explode(F.array_compact(each)).alias("x")).select("site_id", "x.field", "x.value")
    return ingest.counts_by(rows, "site_id", "field", "value")


def label_tokens(df: DataFrame, column: str, separator: str, table: dict[str, str], keep: list[str]) -> DataFrame:
    """keep, native, finding, matched: a row per token; tokens outside the table are OTHER and not matched."""
    known = F.create_map(*[F.lit(x) for k, v in {k.strip().upper(): v for k, v in reversed(table.items())}.items() for x in (k, v)])
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(column), F.lit("")), "\\Q" + separator + "\\E"), F.trim), lambda t: t != "")
    rows = df.select(*keep, F.explode(parts).alias("native"))
    finding = F.try_element_at(known, F.upper("native"))
    return rows.select(*keep, "native", F.coalesce(finding, F.lit("OTHER")).alias("finding"), finding.isNotNull().alias("matched"))


def label_union(*channels: DataFrame) -> DataFrame:
    """study_uid, finding, source, native: channels united, one row for each (study, finding, source)."""
    out = channels[0]
    for c in channels[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out.groupBy("study_uid", "finding", "source").agg(F.min("native").alias("native"), F.max("present").alias("present"))


def entities(rows: DataFrame, order: tuple[str, ...] = ("site_id", "relative_path")) -> dict[str, DataFrame]:
    """patients, studies, series, instances: of each the first row in (site, path) order."""
    o = list(order)
    return {
        "patients": ingest.first_of(rows, ["pseudo_patient_id"], o, ["sex", "age_years"]),
        "studies": ingest.first_of(rows, ["study_uid"], o, ["pseudo_patient_id", "site_id", "study_date", "modality", "body_part"]),
        "series": ingest.first_of(rows, ["series_uid"], o, ["study_uid", "view_position", "laterality"]),
        "instances": ingest.first_of(rows, ["sop_uid"], o, ["series_uid", "relative_path", "sha256"]),
    }
