"""Declared constraints checked on tables: which rows break which rule, and how many.

All rules about single rows are evaluated in one scan. NULL breaks only ``required``; the other
rules speak about values that are there.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.values import parse_object


@dataclass(frozen=True)
class Rule:
    """``broken`` marks violating rows among those where ``checked`` holds."""

    name: str
    checked: Column
    broken: Column

    @property
    def violated(self) -> Column:
        return F.coalesce(self.checked & self.broken, F.lit(False))


def required(name: str, x: Column) -> Rule:
    return Rule(name, F.lit(True), x.isNull())


def length(name: str, x: Column, least: int | None = None, most: int | None = None) -> Rule:
    return Rule(name, x.isNotNull(), _outside(F.length(x), least, most))


def pattern(name: str, x: Column, regex: str) -> Rule:
    """The pattern may match anywhere in the text."""
    return Rule(name, x.isNotNull(), ~x.rlike(regex))


def enum(name: str, x: Column, allowed: Iterable[object]) -> Rule:
    return Rule(name, x.isNotNull(), ~x.isin(*allowed))


def value_range(
    name: str, x: Column, minimum=None, maximum=None,
    exclusive_minimum: bool = False, exclusive_maximum: bool = False,
) -> Rule:
    """The exclusive flags make a bound strict."""
    broken = F.lit(False)
    if minimum is not None:
        broken = broken | (x <= minimum if exclusive_minimum else x < minimum)
    if maximum is not None:
        broken = broken | (x >= maximum if exclusive_maximum else x > maximum)
    return Rule(name, x.isNotNull(), broken)


def multiple_of(name: str, x: Column, divisor: int) -> Rule:
    return Rule(name, x.isNotNull(), x % divisor != 0)


def items(
    name: str, x: Column, least: int | None = None, most: int | None = None, unique: bool = False
) -> Rule:
    broken = _outside(F.size(x), least, most)
    if unique:
        broken = broken | (F.size(F.array_distinct(x)) < F.size(x))
    return Rule(name, x.isNotNull(), broken)


def properties(
    name: str, raw: Column, least: int | None = None, most: int | None = None,
    only: Iterable[str] | None = None,
) -> Rule:
    """Number of members of a JSON object, and the members allowed when others are not.

    Text that is not one whole object, or that gives a key twice, is not checked.
    """
    keys = F.map_keys(parse_object(raw))
    broken = _outside(F.size(keys), least, most)
    if only is not None:
        broken = broken | (F.size(F.array_except(keys, F.array(*map(F.lit, only)))) > 0)
    return Rule(name, keys.isNotNull(), broken)


def dims(name: str, x: Column, count: int) -> Rule:
    return Rule(name, x.isNotNull(), F.size(x) != count)


def _outside(size: Column, least: int | None, most: int | None) -> Column:
    broken = F.lit(False)
    if least is not None:
        broken = broken | (size < least)
    if most is not None:
        broken = broken | (size > most)
    return broken


def violations(rows: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """``(rule, key)`` per broken rule, from one scan."""
    broken = F.array(*[F.when(r.violated, F.lit(r.name)) for r in rules])
    return rows.select(
        F.explode(F.filter(broken, lambda name: name.isNotNull())).alias("rule"),
        F.col(key).cast("string").alias("key"),
    )


def row_report(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(rule, checked, violations)`` for single-row rules, as conditional counts in one scan."""
    counts = rows.agg(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.count_if(r.checked).alias("checked"),
                F.count_if(r.violated).alias("violations"),
            ).alias(f"r{i}")
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(F.array(*[f"r{i}" for i in range(len(rules))])))


def primary_key(rows: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their number of rows."""
    return (
        rows.groupBy(F.col(key).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("key").isNull() | (F.col("copies") > 1))
    )


def foreign_key(rows: DataFrame, field: str, foreign: DataFrame, foreign_field: str) -> DataFrame:
    """Rows whose non-null value is missing from the foreign table."""
    known = foreign.select(F.col(foreign_field).alias(field)).distinct()
    return rows.where(F.col(field).isNotNull()).join(known, field, "left_anti")


def primary_key_report(name: str, rows: DataFrame, key: str) -> DataFrame:
    """Rows checked, and rows whose key is NULL or not unique."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    broken = F.when(F.col(key).isNull() | (F.col("n") > 1), F.col("n")).otherwise(0)
    return counts.agg(
        F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(broken), F.lit(0)).alias("violations"),
    )


def foreign_key_report(
    name: str, rows: DataFrame, field: str, foreign: DataFrame, foreign_field: str
) -> DataFrame:
    """Counted per distinct value first, so that a hot value crosses the shuffle as one row."""
    known = foreign.select(F.col(foreign_field).alias(field)).distinct().withColumn(
        "known", F.lit(True)
    )
    counts = rows.where(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    missing = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    return counts.join(known, field, "left").agg(
        F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("violations"),
    )


def constraint_report(parts: list[DataFrame]) -> DataFrame:
    """All reports as one table."""
    head, *rest = parts
    for part in rest:
        head = head.unionByName(part)
    return head
