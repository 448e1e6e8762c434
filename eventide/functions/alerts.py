"""Alert and anomaly-document records, alert checking and message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ALERT_FIELDS, ALERT_SCHEMA, REQUIRED_ALERT_FIELDS
from .text import iso_seconds

# Fixed values that must equal the reference's: the message template, the
# default for a missing name or region and the severities that notify.
UNKNOWN = "Unknown"
NOTIFY_SEVERITIES = ("high", "medium")
MESSAGE_TEMPLATE = (
    "⚠️ Anomaly detected:\n"
    "User: %d (%s)\n"
    "Region: %s\n"
    "Count: %d\n"
    "Window: %s - %s\n"
    "Z-score: %s\n"
    "Severity: %s"
)


def alert_records(enriched: DataFrame, with_clock: bool = True) -> DataFrame:
    """Alert fields from enriched anomalies; window bounds as ISO text."""
    cols = [
        F.col("user_id"), F.col("user_name"), F.col("region"),
        iso_seconds(F.col("window_start")).alias("window_start"),
        iso_seconds(F.col("window_end")).alias("window_end"),
        F.col("event_count"), F.col("z_score"), F.col("severity"),
    ]
    if with_clock:
        cols.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("detected_at"))
    return enriched.select(*cols)


def to_json_value(df: DataFrame, fields=None) -> Column:
    """One JSON object per row; null fields stay as keys."""
    names = list(fields or df.columns)
    return F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"})


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alert records -> (key, value) pairs for a topic or JSON-lines sink."""
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.col("window_start"), F.col("window_end"))
    present = [c for c in ALERT_FIELDS if c in alerts.columns]
    return alerts.select(key.alias("key"), to_json_value(alerts, present).alias("value"))


def anomaly_documents(enriched: DataFrame, with_clock: bool = True) -> DataFrame:
    """Index documents of type ``anomaly`` (fields in their own places)."""
    cols = [
        F.lit("anomaly").alias("type"), F.col("user_id"), F.col("event_count"),
        iso_seconds(F.col("window_start")).alias("window_start"),
        iso_seconds(F.col("window_end")).alias("window_end"),
        F.col("z_score"), F.col("severity"), F.col("user_name"), F.col("region"),
    ]
    if with_clock:
        cols.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("detected_at"))
        cols.append(F.current_timestamp().alias("logged_at"))
    return enriched.select(*cols)


def decode_alerts(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Alert text -> alert fields plus ``check``: 'valid' or 'missing_<key>'
    for the first required key that is absent or null. The text is parsed
    once: the struct comes out of a generator, as in ``parse.decoded``."""
    value = F.col(value_col).cast("string")
    once = F.array(F.struct(value.alias("value"), F.from_json(value, ALERT_SCHEMA).alias("a")))
    parsed = raw.select(F.inline(once)).select("value", "a.*")
    check = None
    for name in REQUIRED_ALERT_FIELDS:
        miss = F.col(name).isNull()
        label = F.lit(f"missing_{name}")
        check = F.when(miss, label) if check is None else check.when(miss, label)
    return parsed.withColumn("check", check.otherwise(F.lit("valid")))


def render_message(alerts: DataFrame) -> Column:
    """The notification text of a checked alert."""
    return F.format_string(
        MESSAGE_TEMPLATE,
        F.col("user_id"),
        F.coalesce(F.col("user_name"), F.lit(UNKNOWN)),
        F.coalesce(F.col("region"), F.lit(UNKNOWN)),
        F.col("event_count"),
        F.col("window_start"),
        F.col("window_end"),
        F.col("z_score").cast("string"),
        F.col("severity"),
    )


def notifications(checked: DataFrame) -> DataFrame:
    """Valid high/medium alerts with their message."""
    ok = checked.filter((F.col("check") == "valid") & F.col("severity").isin(*NOTIFY_SEVERITIES))
    return ok.select("user_id", "window_start", "window_end", "severity",
                     render_message(ok).alias("message"))
