"""Integrity checks on what is about to be loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame

from deskspark.functions.keys import match_key
from deskspark.plans.spec import EntitySpec


class DomainViolation(ValueError):
    """A column holds values outside its domain."""


class AmbiguousLookup(ValueError):
    """A natural key stands for more than one target row."""


def violation(spec: EntitySpec) -> str:
    """True for a row with a value outside a domain, never NULL; a NULL value is accepted."""
    tests = [
        f"({c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(v) for v in values)}))" for c, values in spec.domain.items()
    ]
    return " OR ".join(tests) or "false"


def domain_violations(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    return rows.filter(violation(spec))


def within_domain(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    return rows.filter(f"NOT ({violation(spec)})")


def ambiguous_keys(target: DataFrame, spec: EntitySpec) -> DataFrame:
    """(key, n) for non-NULL natural keys held by more than one target row."""
    return target.sparkSession.sql(
        f"""SELECT {match_key(spec.key, spec.match)} AS {spec.key}, count(1) AS n FROM {{target}}
            WHERE {spec.key} IS NOT NULL GROUP BY 1 HAVING n > 1""",
        target=target,
    )


def require_unambiguous(target: DataFrame, spec: EntitySpec) -> None:
    found = ambiguous_keys(target, spec).take(5)
    if found:
        raise AmbiguousLookup(f"{spec.name}.{spec.key}: " + ", ".join(f"{r[0]!r} x{r[1]}" for r in found))
