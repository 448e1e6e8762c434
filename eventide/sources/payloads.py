"""Event text derived from the ``events`` table, as a topic would carry it.

Every row becomes one JSON object in the event contract (plus an extra
``event_id`` field, which the parser ignores). With ``spoil`` a fixed share
of rows is damaged in five ways the parser must reject, chosen by
``event_id % 50``: 0 malformed JSON, 1 timestamp without fraction,
2 user_id as quoted text, 3 missing action, 4 empty payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_TIMESTAMP_PATTERN
from .tables import typed_events

SPOIL_MODULUS = 50
SPOIL_REASONS = {0: "malformed_json", 1: "invalid_timestamp", 2: "invalid_user_id",
                 3: "missing_action", 4: "empty_payload"}


def _event_json(ts_text: Column, action: Column) -> Column:
    return F.to_json(F.struct(
        F.col("event_id"),
        F.col("user_id"),
        F.col("product_id"),
        action.alias("action"),
        ts_text.alias("timestamp"),
        F.col("device_id"),
        F.col("device_type"),
        F.col("location"),
        F.col("user_segment"),
        F.col("ip_address"),
    ))


#: Dense feed: this many seconds of the table are one second of the feed.
DENSITY = 720


def dense_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events with their times drawn together, so that windows of seconds
    hold several events of a user; ``day`` is the day in the table."""
    ev = typed_events(spark, sf_dir)
    first = ev.agg(F.min(F.unix_micros(F.col("timestamp").cast("timestamp")))).first()[0] or 0
    since = F.unix_micros(F.col("timestamp").cast("timestamp")) - F.lit(first)
    time = F.timestamp_micros(F.lit(first) + F.expr(f"_since div {DENSITY}")).cast("timestamp_ntz")
    return (ev.withColumn("day", F.to_date("timestamp")).withColumn("_since", since)
            .withColumn("timestamp", time).withColumn("event_time", F.col("timestamp")).drop("_since"))


def event_payloads(spark: SparkSession, sf_dir: str, spoil: bool = True) -> DataFrame:
    """(event_id, event_time, value) with ``value`` the event JSON text."""
    return payloads_of(typed_events(spark, sf_dir), spoil)


def payloads_of(ev: DataFrame, spoil: bool = True) -> DataFrame:
    """``event_payloads`` of typed events (further columns are kept)."""
    others = [c for c in ("day",) if c in ev.columns]
    full_ts = F.date_format(F.col("timestamp"), EVENT_TIMESTAMP_PATTERN)
    if not spoil:
        return ev.select("event_id", "event_time", *others, _event_json(full_ts, F.col("action")).alias("value"))
    m = F.col("event_id") % SPOIL_MODULUS
    no_fraction = F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    text = _event_json(F.when(m == 1, no_fraction).otherwise(full_ts), F.when(m != 3, F.col("action")))
    value = (F.when(m == 4, F.lit(""))
             .when(m == 0, F.expr("substring(_j, 1, length(_j) - 1)"))
             .when(m == 2, F.regexp_replace(F.col("_j"), '"user_id":(-?[0-9]+)', '"user_id":"$1"'))
             .otherwise(F.col("_j")))
    return (ev.select("event_id", "event_time", *others, text.alias("_j"))
            .select("event_id", "event_time", *others, value.alias("value")))
