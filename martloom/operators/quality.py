"""Named data-quality rules: warn, drop or fail.

A rule is a SQL predicate. A row passes when the predicate is true; false and NULL violate it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def as_drop_rules(rules: dict[str, str]) -> list[Expectation]:
    """All rules of a name → predicate map must hold for a row to stay; the map may be empty."""
    return [Expectation(name, predicate, DROP) for name, predicate in rules.items()]


def observe(df: DataFrame, rules: Iterable[Expectation], watch: Observation) -> DataFrame:
    """Count rows and violations as a side effect of whatever job reads the frame.

    An `Observation` serves one job; use a new one per write.
    """
    counts = [F.count_if(~r.passes()).alias(r.name) for r in rules]
    return df.observe(watch, F.count(F.lit(1)).alias("rows_seen"), *counts)


def enforce(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """Apply the drop and fail rules. Runs on the executors as one filter, with no extra job.

    Plain drop rules stay ordinary conjuncts, which reach the file scan. With a fail rule present
    the checks form one CASE, so that no drop rule can hide a row that must stop the job.
    """
    rules = list(rules)
    failing = [r for r in rules if r.action == FAIL]
    dropping = [r for r in rules if r.action == DROP]
    if not failing:
        for r in dropping:
            df = df.filter(F.expr(r.predicate))
        return df
    keep = F.lit(True)
    for r in dropping:
        keep = keep & r.passes()
    broken = [(~r.passes(), F.raise_error(F.lit(f"expectation failed: {r.name}")).cast("boolean")) for r in failing]
    check = F.when(*broken[0])
    for condition, error in broken[1:]:
        check = check.when(condition, error)
    return df.filter(check.otherwise(keep))


def violation_report(df: DataFrame, rules: Iterable[Expectation], table: str) -> DataFrame:
    """One row per rule with its pass and violation counts, from a single pass over the frame."""
    rules = list(rules)
    totals = df.agg(
        F.count(F.lit(1)).alias("rows_seen"),
        *[F.count_if(~r.passes()).alias(f"v{i}") for i, r in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(r.name).alias("rule_name"),
                F.lit(r.action).alias("action"),
                (F.col("rows_seen") - F.col(f"v{i}")).alias("passed"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return totals.select(F.inline(lines))
