"""Dates as sites write them, ages and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: formats in order of trial, with the shape each must have
FORMATS = (("yyyyMMdd", r"^\d{8}$"), ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"), ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"), ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"), ("d MMM yyyy", r"^\d{1,2}\s+[A-Za-z]{3}\s+\d{4}$"))
AGE_CAP = 89
BANDS = ((0, 17, "0-17"), (18, 39, "18-39"), (40, 59, "40-59"), (60, 79, "60-79"), (80, 200, "80+"))


def parse_native_date(c: Column, formats: tuple[tuple[str, str], ...] = FORMATS) -> Column:
    """The first format that fits and names a real day; null if none does."""
    text = F.regexp_replace(F.trim(c), r"\s+", " ")
    return F.coalesce(*[F.try_to_date(F.when(text.rlike(shape), text), f) for f, shape in formats], F.lit(None).cast("date"))


def compute_age(birth: Column, at: Column) -> Column:
    """Whole years of 365 days, at most 89; null if either date is missing or the birth is later."""
    years = F.floor(F.datediff(at, birth) / 365)
    return F.when(F.datediff(at, birth) >= 0, F.least(years, F.lit(AGE_CAP))).cast("int")


def age_string(years: Column) -> Column:
    return F.when(years.isNotNull(), F.format_string("%03dY", years))


def age_band(years: Column) -> Column:
    out = F.lit("unknown")
    for lo, hi, name in reversed(BANDS):
        out = F.when(years.between(lo, hi), F.lit(name)).otherwise(out)
    return out
