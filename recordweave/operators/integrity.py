"""Constraint audits: unique, not null, foreign key, text length."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class NotNull:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    parent: str
    parent_column: str = "id"


@dataclass(frozen=True)
class MaxLength:
    table: str
    columns: Mapping[str, int]


Rule = Unique | NotNull | Reference | MaxLength


def _finding(df: DataFrame, table: str, rule: str, count) -> DataFrame:
    return df.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations"
    )


def _audit(rule: Unique | Reference, tables: Mapping[str, DataFrame], df: DataFrame) -> list[DataFrame]:
    if isinstance(rule, Unique):
        # Rows beyond the first of their key; as in SQL, a NULL never repeats.
        counts = df.dropna(subset=list(rule.columns)).groupBy(*rule.columns)
        label = f"unique({','.join(rule.columns)})"
        extra = F.sum(F.col("_n") - 1)
        return [_finding(counts.agg(F.count(F.lit(1)).alias("_n")), rule.table, label, extra)]
    if isinstance(rule, Reference):
        # Counted per value first, so a hot reference is one row in the join.
        uses = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column)
        parent = tables[rule.parent].select(F.col(rule.parent_column).alias(rule.column))
        orphans = uses.agg(F.count(F.lit(1)).alias("_n")).join(parent, rule.column, "left_anti")
        return [_finding(orphans, rule.table, f"{rule.column}->{rule.parent}", F.sum("_n"))]
    raise TypeError(rule)


def _plain_checks(rules: Sequence[Rule]) -> dict[str, Column]:
    """The conditions of all not-null and length rules of a table, by label."""
    checks: dict[str, Column] = {}
    for rule in rules:
        if isinstance(rule, NotNull):
            checks |= {f"not_null({c})": F.col(c).isNull() for c in rule.columns}
        elif isinstance(rule, MaxLength):
            checks |= {f"length({c})<={n}": F.length(c) > n for c, n in rule.columns.items()}
    return checks


def _plain_findings(name: str, df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One scan for all checks of a table that look at single rows."""
    wide = df.agg(*[F.count_if(bad).alias(label) for label, bad in checks.items()])
    entries = [
        F.struct(F.lit(name).alias("table"), F.lit(label).alias("rule"), F.col(f"`{label}`").alias("violations"))
        for label in checks
    ]
    return wide.select(F.inline(F.array(*entries)))


def audit(
    rules: Sequence[Rule], tables: Mapping[str, DataFrame], fresh: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """(table, rule, violations), one row per rule and column; one scan per table for its plain rules.

    With ``fresh``, the rows that came last, only they are looked at, except for unique keys, which need all.
    """
    given = tables if fresh is None else fresh
    findings = [
        f for rule in rules if isinstance(rule, Unique | Reference)
        for f in _audit(rule, tables, tables[rule.table] if isinstance(rule, Unique) else given[rule.table])
    ]
    for name in dict.fromkeys(rule.table for rule in rules):
        checks = _plain_checks([rule for rule in rules if rule.table == name])
        if checks:
            findings.append(_plain_findings(name, given[name], checks))
    return reduce(DataFrame.union, findings)


class IntegrityError(ValueError):
    """Loaded tables break a constraint."""


def require_integrity(findings: DataFrame) -> None:
    broken = findings.filter("violations > 0").take(20)
    if broken:
        shown = "; ".join(f"{r.table} {r.rule}: {r.violations}" for r in broken)
        raise IntegrityError(shown)
