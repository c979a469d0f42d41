"""How queries register: a name, the DataFrame version, and SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The fixture tables by name, read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir, self._have = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._have:
            self._have[name] = table(self.spark, self._dir, name)
        return self._have[name]


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of Tables."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return f

    return add


KEY = b"fixture key, not a secret"
PADS = [bytes(b ^ p for b in KEY.ljust(64, b"\0")).hex() for p in (0x36, 0x5C)]


def sql_mac(domain: str, value: str) -> str:
    """DuckDB SQL of identity.mac(KEY, domain, value)."""
    message = f"unhex('{domain.encode().hex()}00') || encode({value})"
    return f"sha256(unhex('{PADS[1]}') || unhex(sha256(unhex('{PADS[0]}') || {message})))"


def sql_bucket(salt: str, key: str) -> str:
    return f"CAST(CAST(('0x' || substr(sha256({salt} || chr(31) || {key}), 1, 16)) AS UBIGINT) % 1000000 AS INTEGER)"


def sql_split(bucket: str) -> str:
    return f"CASE WHEN {bucket} < 800000 THEN 'train' WHEN {bucket} < 900000 THEN 'val' ELSE 'test' END"


def sql_band(age: str) -> str:
    return f"CASE WHEN {age} BETWEEN 0 AND 17 THEN '0-17' WHEN {age} BETWEEN 18 AND 39 THEN '18-39' WHEN {age} BETWEEN 40 AND 59 THEN '40-59' WHEN {age} BETWEEN 60 AND 79 THEN '60-79' WHEN {age} BETWEEN 80 AND 200 THEN '80+' ELSE 'unknown' END"
