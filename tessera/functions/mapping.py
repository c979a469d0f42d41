"""Site rules compiled to CASE expressions: exact values, then ordered patterns, then a default."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip


@dataclass(frozen=True)
class RuleSet:
    """exact: value -> canonical (case and outer space don't count, the first of equal keys wins); patterns in order."""

    default: str
    exact: dict[str, str] = field(default_factory=dict)
    patterns: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        for p, _ in self.patterns:
            re.compile(p)

    def resolve(self, c: Column) -> Column:
        """struct<value, matched>; a blank input isn't matched."""
        text = strip(F.coalesce(c, F.lit("")))
        key, cases, seen = F.upper(text), [], set()
        for k, v in self.exact.items():
            if k.strip().upper() not in seen:
                seen.add(k.strip().upper())
                cases.append((key == k.strip().upper(), v))
        cases += [(text.rlike(f"(?i){p}"), v) for p, v in self.patterns]
        value = F.lit(None).cast("string")
        for test, v in reversed(cases):
            value = F.when(test, F.lit(v)).otherwise(value)
        value = F.when(text != "", value)
        return F.struct(F.coalesce(value, F.lit(self.default)).alias("value"), value.isNotNull().alias("matched"))


def by_site(site: Column, rules: dict[str, RuleSet], c: Column) -> Column:
    """Each site's rules in one expression; null for a site without rules."""
    out = F.lit(None).cast("struct<value:string,matched:boolean>")
    for s, r in rules.items():
        out = F.when(site == s, r.resolve(c)).otherwise(out)
    return out


def is_unmapped(resolved: Column, c: Column) -> Column:
    """Not matched although not blank: what the unmapped counter counts."""
    return ~resolved["matched"] & (strip(F.coalesce(c, F.lit(""))) != "")
