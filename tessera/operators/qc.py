"""Quality control: every check is a named row of one table, computed from a few aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import vocab

VIEW_IMBALANCE = 0.35
PARITY_GAP = 0.25
BODY_PART = 0.01


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose key no parent has; null keys are orphans too."""
    return child.join(parent.select(F.col(parent_key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")


def duplicate_digests(df: DataFrame, digest: str, example: str, most: int = 5) -> DataFrame:
    """digest, n, examples: contents held more than once, with their first names.

    A window that stops at the first ranks leaves a task of the input `most` names of a digest at most, so a large group
    is neither collected nor sent to one task.
    """
    rows = df.select(F.struct(F.col(digest).alias("digest")).alias("_k"), F.col(example).alias("_e"))  # in a struct null meets null
    counts = rows.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1")
    least = rows.where("_e IS NOT NULL").withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy("_e"))).where(F.col("_r") <= most)
    examples = least.groupBy("_k").agg(F.array_sort(F.collect_list("_e")).alias("examples"))
    return counts.join(examples, "_k", "left").select("_k.digest", "n", F.coalesce("examples", F.array()).alias("examples"))


def missing(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """field, n_bad, n_total, fraction in one pass; 0 of 0 is 0."""
    cells = df.agg(F.count("*").alias("_n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()])
    rows = cells.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("n_bad"), F.col("_n").alias("n_total")) for k in tests])).alias("x")).select("x.*")
    return rows.withColumn("fraction", F.when(F.col("n_total") > 0, F.col("n_bad") / F.col("n_total")).otherwise(0.0))


def view_balance(rows: DataFrame, site: str, is_ap: Column) -> DataFrame:
    """site, n_ap, n, fraction."""
    return rows.groupBy(F.col(site).alias("site")).agg(F.count_if(is_ap).alias("n_ap"), F.count("*").alias("n")).withColumn("fraction", F.col("n_ap") / F.col("n"))


def label_prevalence(labels: DataFrame, studies: DataFrame, study: str, site: str, finding: str) -> DataFrame:
    """site, finding, n_labels, n_studies, percent: label rows per 100 studies of the site."""
    size = studies.groupBy(F.col(site).alias("site")).agg(F.count_distinct(study).alias("n_studies"))
    own = labels.join(studies.select(study, F.col(site).alias("site")).distinct(), study).groupBy("site", F.col(finding).alias("finding")).agg(F.count("*").alias("n_labels"))
    return own.join(size, "site").select("site", "finding", "n_labels", "n_studies", (F.lit(100) * F.col("n_labels") / F.col("n_studies")).alias("percent"))


def cross_site(rows: DataFrame, patient: str, site: str) -> DataFrame:
    return rows.groupBy(F.col(patient).alias("patient")).agg(F.count_distinct(site).alias("n_sites")).where("n_sites > 1")


def invalid(df: DataFrame, table: str) -> DataFrame:
    """column, n_bad: values outside the column's domain; nulls are for the missing() check."""
    tests = {}
    for column, rule in vocab.DOMAINS[table].items():
        if column not in df.columns:
            continue
        c = F.col(column)
        if isinstance(rule, str):
            tests[column] = ~c.rlike(rule)
        elif isinstance(rule[0], int) or rule[0] is None:
            low, high = rule
            tests[column] = (c < low if low is not None else F.lit(False)) | (c > high if high is not None else F.lit(False))
        else:
            tests[column] = ~c.isin(*rule)
    return missing(df, tests).select(F.col("field").alias("column"), "n_bad")


def validate(df: DataFrame, table: str, columns: set[str] | None = None) -> DataFrame:
    """df; unknown columns raise at once, a value outside its domain fails the query."""
    unknown = set(df.columns) - (columns or set(df.columns))
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    for column, rule in vocab.DOMAINS[table].items():
        if column in df.columns:
            c = F.col(column)
            ok = c.rlike(rule) if isinstance(rule, str) else c.between(rule[0], rule[1] if rule[1] is not None else (1 << 31) - 1) if isinstance(rule[0], int) else c.isin(*rule)
            df = df.where(F.when(F.coalesce(ok, F.lit(True)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{table}.{column}: "), c.cast("string"))).cast("boolean")))
    return df


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    bad: DataFrame  # one row, columns n_bad and n_total
    limit: float = 0.0  # the largest fraction of bad rows that passes


def count_check(name: str, severity: str, bad: DataFrame, total: DataFrame, limit: float = 0.0) -> Check:
    return Check(name, severity, bad.agg(F.count("*").alias("n_bad")).crossJoin(total.agg(F.count("*").alias("n_total"))), limit)


def report(checks: list[Check]) -> DataFrame:
    """check, severity, n_bad, n_total, passed: a row a check."""
    out = None
    for c in checks:
        frac = F.when(F.col("n_total") > 0, F.col("n_bad") / F.col("n_total")).otherwise(F.when(F.col("n_bad") > 0, 1.0).otherwise(0.0))
        row = c.bad.select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col("n_bad").cast("long").alias("n_bad"), F.col("n_total").cast("long").alias("n_total"), (F.lit(c.severity == "info") | (frac <= c.limit)).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out


def standard_checks(t: dict[str, DataFrame]) -> list[Check]:
    """The checks that rows alone decide, over tables patients, studies, series, instances, labels, unmapped, quarantine.

    t["strata"] (stratum, n_studies) and t["gaps"] (gap), if there, add the equity checks.
    """
    s, pat, ser, lab, ins = t["studies"], t["patients"], t["series"], t["labels"], t["instances"]
    distinct_minus_one = lambda df, c: df.agg(F.greatest(F.count_distinct(c) - 1, F.lit(0)).alias("n_bad"), F.count("*").alias("n_total"))
    sites = s.select("study_uid", "site_id")
    balance = view_balance(ser.join(sites, "study_uid"), "site_id", F.col("view_position") == "AP")
    spread = balance.agg((F.coalesce(F.max("fraction") - F.min("fraction"), F.lit(0.0)) > VIEW_IMBALANCE).cast("long").alias("n_bad"), F.count("*").alias("n_total"))
    out = [
        count_check("study_patient_integrity", "fail", orphans(s, "pseudo_patient_id", pat, "pseudo_id"), s),
        count_check("series_study_integrity", "fail", orphans(ser, "study_uid", s, "study_uid"), ser),
        count_check("label_study_integrity", "fail", orphans(lab, "study_uid", s, "study_uid"), lab),
        count_check("instance_series_integrity", "fail", orphans(ins, "series_uid", ser, "series_uid"), ins),
        count_check("studies_have_images", "fail", orphans(s, "study_uid", ser, "study_uid"), s),
        Check("photometric_interpretation_uniform", "fail", distinct_minus_one(ins, "photometric_interpretation")),
        Check("no_duplicate_pixel_content", "warn", ins.agg((F.count("sha256") - F.count_distinct("sha256")).alias("n_bad"), F.count("*").alias("n_total"))),
        count_check("study_date_present", "warn", s.where("study_date IS NULL"), s),
        count_check("projection_resolved", "warn", ser.where("view_position = 'UNKNOWN'"), ser),
        count_check("body_part_scope_verified", "fail", s.where("coalesce(body_part, '') = ''"), s, BODY_PART),
        count_check("body_part_attested", "warn", s.where("coalesce(body_part, '') = ''"), s),
        count_check("sex_resolved", "warn", pat.where("sex = 'U'"), pat),
        count_check("age_present", "warn", pat.where("age_years IS NULL"), pat),
        count_check("studies_labelled", "warn", orphans(s, "study_uid", lab, "study_uid"), s),
        count_check("all_values_mapped", "warn", t["unmapped"], t["unmapped"]),
        Check("projection_balance_across_sites", "warn", spread, 0.0),
        count_check("label_prevalence_recorded", "info", lab.limit(0), lab),
        count_check("cross_site_patients_linked", "info", cross_site(s, "pseudo_patient_id", "site_id"), pat),
        count_check("pixel_redaction_recorded", "info", ins.where("pixel_redacted"), ins),
        count_check("ingest_attrition_accounted", "info", t["quarantine"], t["quarantine"]),
    ]
    if "strata" in t:
        small = t["strata"].where("n_studies < 30")
        out.append(count_check("strata_adequately_represented", "warn", small, t["strata"]))
        out.append(count_check("demographics_recorded", "warn", pat.where("sex = 'U' OR age_years IS NULL"), pat))
    if "gaps" in t:
        out.append(count_check("finding_prevalence_parity", "warn", t["gaps"].where(F.col("gap") > PARITY_GAP), t["gaps"]))
    return out


def passed(report_rows: DataFrame, strict: bool = False) -> bool:
    """No failed check of severity fail (or, if strict, warn)."""
    bad = ["fail", "warn"] if strict else ["fail"]
    return report_rows.where(~F.col("passed") & F.col("severity").isin(bad)).isEmpty()


def markdown(rows: DataFrame) -> str:
    """The report, problems first; a row a check, so it is small."""
    lines = ["| check | severity | bad | of | passed |", "|-|-|-|-|-|"]
    got = sorted(rows.collect(), key=lambda r: (r["passed"], vocab.SEVERITIES.index(r["severity"]), r["check"]))
    return "\n".join(lines + [f"| {r['check']} | {r['severity']} | {r['n_bad']} | {r['n_total']} | {'yes' if r['passed'] else 'NO'} |" for r in got]) + "\n"
