"""Store constraints as row predicates, checked before a write so that only
offending rows are rejected (not the whole chunk)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_NOT_NULL, RAW_TEXT_LIMITS


def store_rules(not_null: Sequence[str] = RAW_NOT_NULL,
                limits: Sequence[tuple[str, int]] = RAW_TEXT_LIMITS) -> list[tuple[str, Column]]:
    """(rule name, violation predicate) in check order."""
    rules = [(f"{c}_not_null", F.col(c).isNull()) for c in not_null]
    rules += [(f"{c}_max_{n}", F.coalesce(F.length(F.col(c)) > F.lit(n), F.lit(False))) for c, n in limits]
    return rules


def violation_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, violations) for every rule, from a single scan: one partial
    aggregate of one counter per rule, then unpivoted."""
    sums = df.agg(*[F.sum(F.when(pred, 1).otherwise(0)).alias(name) for name, pred in rules])
    stacked = ", ".join(f"'{name}', `{name}`" for name, _ in rules)
    return sums.selectExpr(f"stack({len(rules)}, {stacked}) AS (rule, violations)").select(
        "rule", F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


def first_violation(rules: list[tuple[str, Column]]) -> Column:
    reason = None
    for name, pred in rules:
        reason = F.when(pred, F.lit(name)) if reason is None else reason.when(pred, F.lit(name))
    return reason


def split_valid(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reason``). Persist ``df`` first when
    both are written, so the input is read once."""
    tagged = df.withColumn("_reason", first_violation(rules))
    valid = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    rejects = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return valid, rejects
