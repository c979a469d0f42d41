"""Roles: which rows of which tables a role may see; everything else is refused. Aggregates are open to all roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: tables whose rows a role may read
ALLOWED = {
    "curator": ("patients", "studies", "series", "instances", "reports", "labels", "splits"),
    "modeller": ("patients", "studies", "series", "instances", "labels", "splits"),
    "auditor": (),
}
#: The role of a user who names none.
LEAST = "auditor"


class AccessDenied(PermissionError):
    """Names the role, the table, and the roles that hold the grant."""

    def __init__(self, role: str, table: str):
        holders = [r for r, tables in ALLOWED.items() if table in tables]
        super().__init__(f"rows of {table!r} are closed to {role!r}, open to: {', '.join(holders) or 'nobody'}")


def view(df: DataFrame, role: str, table: str, hidden: tuple[str, ...] = ()) -> DataFrame:
    """The rows of a table as a role sees them: whole for a curator, without the hidden columns for others."""
    granted = ALLOWED.get(role, ())
    if table not in granted:
        raise AccessDenied(role, table)
    return df if role == "curator" else df.drop(*hidden)


def cohort_summary(studies: DataFrame, patients: DataFrame, patient: str, study: str, site: str, sex: str) -> DataFrame:
    """site, sex, n_studies, n_patients: the only shape an auditor needs, open to every role."""
    both = studies.join(patients, patient)
    return both.groupBy(F.col(site).alias("site"), F.col(sex).alias("sex")).agg(F.count_distinct(study).alias("n_studies"), F.count_distinct(patient).alias("n_patients"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n of each table, in one query."""
    parts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def record_splits(df: DataFrame, path: str, release: str) -> None:
    """Replaces the rows of one release in a table partitioned by release_version."""
    df.withColumn("release_version", F.lit(release)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release_version").parquet(path)
