"""Constraint checks: rules in, one row per violation out.

As with a database CHECK, a null passes every rule but the ones about nulls and keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import email_is_valid
from driftline.operators.keyed import DEFAULT_POLICY, SkewPolicy, over_key
from driftline.operators.relations import orphans
from driftline.schemas import TEXT, row_type
from driftline.session import few_rows


@dataclass(frozen=True)
class RowRule:
    """A rule decided on the row alone: `broken` says when, `value` what to show."""

    name: str
    broken: Column
    value: Column


@dataclass(frozen=True)
class UniqueRule:
    name: str
    columns: tuple[str, ...]
    is_key: bool = False


@dataclass(frozen=True)
class ReferenceRule:
    name: str
    column: str
    parents: DataFrame
    parent_column: str


Rule = RowRule | UniqueRule | ReferenceRule


def not_null(column: str) -> RowRule:
    return RowRule(f"{column} not null", F.col(column).isNull(), F.lit(None).cast("string"))


def allowed(column: str, values: Sequence[str]) -> RowRule:
    return RowRule(f"{column} allowed", ~F.col(column).isin(*values), F.col(column))


def at_most(column: str, width: int) -> RowRule:
    return RowRule(f"{column} length <= {width}", F.length(column) > width, F.col(column))


def at_least(column: str, low: float | int) -> RowRule:
    return RowRule(f"{column} >= {low}", F.col(column) < low, F.col(column))


def above(column: str, low: float | int) -> RowRule:
    return RowRule(f"{column} > {low}", F.col(column) <= low, F.col(column))


def email_shape(column: str) -> RowRule:
    return RowRule(f"{column} is an email", ~email_is_valid(F.col(column)), F.col(column))


def primary_key(*columns: str) -> UniqueRule:
    return UniqueRule(f"primary key {', '.join(columns)}", columns, is_key=True)


def unique(*columns: str) -> UniqueRule:
    return UniqueRule(f"unique {', '.join(columns)}", columns)


def references(column: str, parents: DataFrame, parent_column: str) -> ReferenceRule:
    return ReferenceRule(f"{column} references {parent_column}", column, parents, parent_column)


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def violations(df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """(rule, key, value) of every violation. All row rules share one pass over the table."""
    parts = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        found = [
            F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), r.value.cast("string").alias("value")))
            for r in row_rules
        ]
        hit = F.explode(F.array_compact(F.array(*found))).alias("hit")
        parts.append(df.select(_key_text(key).alias("key"), hit).select("hit.rule", "key", "hit.value"))
    for r in rules:
        if isinstance(r, UniqueRule):
            parts.append(_duplicates(df, r))
        elif isinstance(r, ReferenceRule):
            lost = orphans(df, r.column, r.parents, r.parent_column)
            parts.append(
                lost.select(F.lit(r.name).alias("rule"), _key_text(key).alias("key"), F.col(r.column).cast("string").alias("value"))
            )
    nothing = F.lit(None).cast("string").alias("value")
    out = parts[0] if parts else df.select(F.lit("").alias("rule"), _key_text(key).alias("key"), nothing).limit(0)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _duplicates(df: DataFrame, rule: UniqueRule) -> DataFrame:
    """Repeated values, and missing ones where they are the key. Counted before the shuffle,
    so a value with very many copies is no larger than any other."""
    any_null = F.lit(False)
    for c in rule.columns:
        any_null = any_null | F.col(c).isNull()
    counted = df.groupBy(*rule.columns).agg(F.count("*").alias("n"))
    wrong = (F.col("n") > 1) & ~any_null
    if rule.is_key:
        wrong = wrong | any_null
    return counted.filter(wrong).select(
        F.lit(rule.name).alias("rule"), _key_text(rule.columns).alias("key"), F.col("n").cast("string").alias("value")
    )


def rule_summary(df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule and whether it holds, rules without violations included."""
    names = few_rows(df.sparkSession, row_type(rule=TEXT), [(r.name,) for r in rules])
    counted = violations(df, key, rules).groupBy("rule").agg(F.count("*").alias("violations"))
    return names.join(counted, "rule", "left").select(
        "rule",
        F.coalesce("violations", F.lit(0)).alias("violations"),
        F.col("violations").isNull().alias("passed"),
    )


def status_changes(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    status: str,
    transitions: Sequence[tuple[str, str]],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every change of status with the one before it, and whether that step is allowed."""
    stepped = over_key(changes, keys, order, lag={"previous_status": F.col(status)}, policy=policy)
    steps = F.array(*[F.lit(f"{a}>{b}") for a, b in transitions])
    return stepped.filter(
        F.col("previous_status").isNotNull() & (F.col("previous_status") != F.col(status))
    ).withColumn("is_allowed", F.array_contains(steps, F.concat_ws(">", "previous_status", status)))
