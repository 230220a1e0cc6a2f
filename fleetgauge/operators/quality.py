"""Declared data-quality rules.

A row breaks a rule only where its predicate is FALSE. A predicate that is
NULL passes, as in a CHECK constraint, and is counted apart.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A named predicate; ``action`` is ``"drop"`` or ``"warn"`` (keep, count)."""

    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("drop", "warn"):
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(True))


def apply_expectations(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """Drop the rows that break a ``drop`` rule; ``warn`` rules drop nothing."""
    for rule in rules:
        if rule.action == "drop":
            df = df.where(rule.holds())
    return df


def rejected(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """The rows :func:`apply_expectations` drops, with the rules they break."""
    dropping = [r for r in rules if r.action == "drop"]
    if not dropping:
        return df.withColumn("broken", F.array().cast("array<string>")).where(F.lit(False))
    broken = F.array_compact(
        F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in dropping])
    )
    return df.withColumn("broken", broken).where(F.size("broken") > 0)


def metric_columns(rules: Iterable[Expectation]) -> list[Column]:
    """Counters ``<rule>_passed``, ``<rule>_failed``, ``<rule>_nulls``."""
    columns = []
    for rule in rules:
        value = F.expr(rule.predicate)
        columns += [
            F.count_if(value).alias(f"{rule.name}_passed"),
            F.count_if(~value).alias(f"{rule.name}_failed"),
            F.count_if(value.isNull()).alias(f"{rule.name}_nulls"),
        ]
    return columns


def quality_metrics(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """One row per rule, from a single pass over the data before any drop."""
    rules = list(rules)
    totals = df.agg(*metric_columns(rules))
    line = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.action).alias("action"),
                    F.col(f"{r.name}_passed").alias("passed"),
                    F.col(f"{r.name}_failed").alias("failed"),
                    F.col(f"{r.name}_nulls").alias("nulls"),
                )
                for r in rules
            ]
        )
    )
    return totals.select(line.alias("m")).select("m.*")

