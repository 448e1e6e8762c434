"""Uniqueness on a natural key in a stream, with the refused rows kept visible.

``with_firsts`` is the streaming part: Spark's stateful
``dropDuplicatesWithinWatermark`` decides which keys are new, whatever the
trigger, restart or partition a row comes in; its state holds the keys of the
watermark's time only. ``resolve`` is the micro-batch part: one aggregate over
the tagged rows gives for every key the row to store and how many copies of
every row are refused. No stored row is read for either."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _able(nullable: Sequence[str]) -> Column:
    """Rows that can collide: as in SQL, a null in the key equals nothing."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in nullable], F.lit(True))


def with_firsts(rows: DataFrame, candidates: Column, keys: Sequence[str], nullable: Sequence[str],
                time_col: str, within: str) -> DataFrame:
    """All ``rows`` with ``first`` false, and beside them, with ``first`` true,
    one row of every key not met before among the ``candidates``."""
    firsts = rows.filter(candidates & _able(nullable)).withWatermark(time_col, within).dropDuplicatesWithinWatermark(list(keys))
    return rows.withColumn("first", F.lit(False)).unionByName(firsts.withColumn("first", F.lit(True)))


def resolve(tagged: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column,
            nullable: Sequence[str] = (), seen: DataFrame | None = None) -> DataFrame:
    """``columns`` with ``stored`` (the row goes to the store) and ``refused``
    (copies of it that do not), a row for each distinct row.

    Of the rows of a new key the one with the lowest ``order`` (a number of
    fixed width) is stored, so a replay stores the same. ``seen`` holds keys
    that are taken although no state knows them. Both aggregates combine
    map-side; a key or a row that a large share of the batch repeats is a few
    rows after that. Rows with a null in the key are all stored."""
    keys, columns = list(keys), list(columns)
    arrived = F.sum(F.when(F.col("first"), 0).otherwise(1))
    distinct = tagged.groupBy(*columns).agg(arrived.alias("copies"), F.max("first").alias("first")).withColumn(
        "_order", order)
    able = distinct.filter(_able(nullable))
    winners = able.groupBy(*keys).agg(F.max("first").alias("_new"), F.min("_order").alias("_best"))
    if seen is not None:
        known = seen.select(*keys).join(winners.select(*keys), keys, "left_semi").distinct()
        winners = winners.join(known.withColumn("_seen", F.lit(True)), keys, "left").withColumn(
            "_new", F.col("_new") & F.col("_seen").isNull()).drop("_seen")
    stored = F.col("_new") & (F.col("_order") == F.col("_best"))
    kept = able.join(winners, keys).select(
        *columns, stored.alias("stored"), (F.col("copies") - F.when(stored, 1).otherwise(0)).alias("refused"))
    # rows that cannot collide are stored as often as they came
    free = distinct.filter(~_able(nullable)).select(
        *columns, F.lit(True).alias("stored"), F.lit(0).cast("long").alias("refused"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_n")).drop("_n")
    return kept.unionByName(free)
