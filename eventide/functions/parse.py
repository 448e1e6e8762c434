"""Event text -> typed rows, with the reason each rejected row was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EVENT_SCHEMA, EVENT_TIMESTAMP_PATTERN, REQUIRED_EVENT_FIELDS

JSON_OPTIONS = {"timestampFormat": EVENT_TIMESTAMP_PATTERN}

# Reject reasons, first matching rule wins.
EMPTY_PAYLOAD = "empty_payload"
MALFORMED_JSON = "malformed_json"
REQUIRED_REASONS = {
    "user_id": "invalid_user_id",
    "product_id": "invalid_product_id",
    "action": "missing_action",
    "event_time": "invalid_timestamp",
}


def decode(value: Column) -> Column:
    """Payload (binary or text) -> event struct; PERMISSIVE, so malformed JSON
    gives a struct of nulls and an empty payload gives null."""
    return F.from_json(value.cast("string"), EVENT_SCHEMA, JSON_OPTIONS)


def decoded(raw: DataFrame, value_col: str = "value", keep_value: bool = False) -> DataFrame:
    """(value?, data): the payload parsed exactly once per row.

    The struct comes out of a one-element ``inline`` generator. Filters on it
    then stay above the Generate: without it Catalyst pushes them below the
    projection by inlining ``from_json`` into every predicate (null check,
    each required field), and the text would be parsed several times per row."""
    value = F.col(value_col).cast("string")
    out = raw.select(F.inline(F.array(F.struct(value.alias("value"), decode(value).alias("data")))))
    return out if keep_value else out.select("data")


def parse_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed events plus ``event_time``; rows missing a required field dropped."""
    return (
        decoded(raw, value_col)
        .filter(F.col("data").isNotNull())
        .select("data.*")
        .withColumn("event_time", F.col("timestamp"))
        .transform(with_required)
    )


def with_required(events: DataFrame) -> DataFrame:
    """Rows that have all required fields."""
    return events.dropna(subset=list(REQUIRED_EVENT_FIELDS))


def reject_reason(data: Column) -> Column:
    """Why a decoded payload cannot become an event (null when it can)."""
    fields = [f.name for f in EVENT_SCHEMA.fields]
    all_null = F.lit(True)
    for name in fields:
        all_null = all_null & data.getField(name).isNull()
    reason = F.when(data.isNull(), F.lit(EMPTY_PAYLOAD)).when(all_null, F.lit(MALFORMED_JSON))
    for name, why in REQUIRED_REASONS.items():
        source = "timestamp" if name == "event_time" else name
        reason = reason.when(data.getField(source).isNull(), F.lit(why))
    return reason


def classify(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """One pass: (value, data struct, reason); reason null for good rows."""
    return decoded(raw, value_col, keep_value=True).withColumn("reason", reject_reason(F.col("data")))


def good_rows(classified: DataFrame) -> DataFrame:
    return (classified.filter(F.col("reason").isNull()).select("data.*")
            .withColumn("event_time", F.col("timestamp")))


def rejected_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select("reason", F.col("value").alias("row"))
