"""Keyed merges of a batch into a table and null-distinct natural-key dedup."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: every source row, plus target rows whose key the source lacks
    (new value replaces old). Source keys are unique per batch.

    The anti-join lets Spark broadcast the (small) source keys so a large
    target is never shuffled; the source is read twice (rows and keys), so
    pass a persisted micro-batch or a cheap plan."""
    keep = target.join(source.select(*keys), list(keys), "left_anti")
    return source.unionByName(keep)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-ignore: every target row, plus source rows with a new key
    (the first row stored for a key stays). Same join shape as
    ``merge_upsert`` with the roles swapped."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


#: Types that an aggregate keeps in place, so that it can hash instead of sorting.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def natural_key_dedup(df: DataFrame, keys: dict[str, Column], order_col: str, nullable: Sequence[str] = ()) -> DataFrame:
    """The row with the lowest ``order_col`` (a unique row number) of every
    natural key.

    ``keys`` maps a name to the key expression (e.g. a truncated timestamp); a
    key named like a column of ``df`` is that column. Like a SQL unique
    constraint, a row with null in any ``nullable`` key column never collides:
    its row number joins its key. One scan and one shuffle on the key; the
    aggregate combines map-side, so a hot key is reduced before it, and hashes
    as long as the columns outside the key are of fixed width (text there makes
    Spark sort instead)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in nullable], F.lit(False))
    group = [expr.alias(f"_k_{name}") for name, expr in keys.items()]
    rest = [c for c in fields if c not in keys and c != order_col]
    narrow = [c for c in rest if isinstance(fields[c], FIXED_WIDTH)]
    wide = [c for c in rest if c not in narrow]
    best = [F.min_by(F.col(c), F.col(order_col)).alias(c) for c in narrow]
    if wide:
        best.append(F.min_by(F.struct(*wide), F.col(order_col)).alias("_wide"))
    first = df.groupBy(*group, F.when(any_null, F.col(order_col)).alias("_alone")).agg(
        F.min(order_col).alias(order_col), *best)
    return first.select(*(F.col(f"_k_{c}").alias(c) if c in keys else F.col(f"_wide.{c}") if c in wide else F.col(c)
                          for c in fields))
