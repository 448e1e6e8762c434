"""Batch audit records: one row per raw batch and per aggregate batch.

A streaming batch gets its record from metrics observed on the write itself
(``*_record_of``); the other form counts a table that is not being written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anomaly import EMITTED_SEVERITIES, EXACT, mean_col, stddev_col


def emitted_count() -> Column:
    """How many graded rows leave the detector (also as an observed metric)."""
    leaves = F.col("is_anomaly") & F.col("severity").isin(*EMITTED_SEVERITIES)
    return F.coalesce(F.sum(F.when(leaves, 1).otherwise(0)), F.lit(0)).cast("long")


def agg_batch_record(graded: DataFrame, batch_id: int, window_type: str, z_threshold: float,
                     with_clock: bool = True) -> DataFrame:
    """records, emitted anomalies, mean and population stddev of the counts,
    in one aggregate over a graded batch."""
    c = F.col("event_count").cast(EXACT)
    sums = graded.agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("s1"), F.sum(c * c).alias("q"),
                      emitted_count().alias("anomalies"))
    return agg_record_of(sums, batch_id, window_type, z_threshold, with_clock)


def agg_record_of(sums: DataFrame, batch_id: int, window_type: str, z_threshold: float,
                  with_clock: bool = True) -> DataFrame:
    """The record from a batch's moments n, s1, q and its emitted anomalies."""
    n, s1, q = F.col("n"), F.col("s1"), F.col("q")
    cols = [
        F.lit("agg_batch").alias("type"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(window_type).alias("window_type"),
        n.alias("records"),
        F.col("anomalies").cast("long").alias("anomalies"),
        F.when(n > 0, mean_col(n, s1)).otherwise(F.lit(0.0)).alias("mean_event_count"),
        F.when(n > 0, stddev_col(n, s1, q)).otherwise(F.lit(0.0)).alias("stddev_event_count"),
        F.lit(float(z_threshold)).alias("z_threshold"),
    ]
    if with_clock:
        cols.append(F.current_timestamp().alias("logged_at"))
    return sums.select(*cols)


def raw_batch_record(written: DataFrame, batch_id: int, with_clock: bool = True) -> DataFrame:
    """Rows accepted by the store in one raw batch, counted."""
    return raw_record_of(written.agg(F.count(F.lit(1)).alias("records")), batch_id, with_clock)


def raw_record_of(count: DataFrame, batch_id: int, with_clock: bool = True) -> DataFrame:
    """The record from a number of rows (and any facts beside it)."""
    cols = [F.lit("raw_batch").alias("type"), F.lit(batch_id).cast("long").alias("batch_id"),
            *[F.col(c) for c in count.columns]]
    if with_clock:
        cols.append(F.current_timestamp().alias("logged_at"))
    return count.select(*cols)


def as_log_records(record: DataFrame) -> DataFrame:
    """Any audit/document row -> (type, batch_id, logged_at, payload JSON)."""
    payload = F.to_json(F.struct(*[F.col(c) for c in record.columns]), {"ignoreNullFields": "false"})
    batch = F.col("batch_id") if "batch_id" in record.columns else F.lit(None).cast("long")
    return record.select(F.col("type"), batch.cast("long").alias("batch_id"),
                         F.col("logged_at"), payload.alias("payload"))
