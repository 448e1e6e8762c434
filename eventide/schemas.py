"""Record contracts: event, alert, dimension and log records."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's: the event text contract,
# its timestamp pattern, the required fields, the stored column order and
# the text limits of the raw event store.
EVENT_TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SECONDS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"

EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("action", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("user_segment", T.StringType(), True),
    T.StructField("ip_address", T.StringType(), True),
])

REQUIRED_EVENT_FIELDS = ("user_id", "product_id", "action", "event_time")

RAW_COLUMNS = ("user_id", "product_id", "action", "timestamp", "device_id",
               "device_type", "location", "user_segment", "ip_address")

RAW_NOT_NULL = ("user_id", "product_id", "action", "timestamp")
RAW_TEXT_LIMITS = (("action", 50), ("device_id", 50), ("device_type", 50),
                   ("location", 100), ("user_segment", 50), ("ip_address", 50))
RAW_NATURAL_KEY = ("user_id", "timestamp", "action", "device_id")

SUMMARY_KEY = ("user_id", "window_start", "window_end")
SUMMARY_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("event_count", T.LongType()),
])

ALERT_FIELDS = ("user_id", "user_name", "region", "window_start", "window_end",
                "event_count", "z_score", "severity", "detected_at")
REQUIRED_ALERT_FIELDS = ("user_id", "event_count", "window_start", "window_end",
                         "z_score", "severity")

ALERT_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("detected_at", T.StringType()),
])

USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

RAW_STORE_SCHEMA = T.StructType([
    *[T.StructField(f.name, f.dataType) for f in EVENT_SCHEMA.fields],
    T.StructField("event_date", T.DateType()),
    T.StructField("run", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

LOG_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("payload", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("run", T.LongType()),
])

LETTER_SCHEMA = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("row", T.StringType()),
    T.StructField("copies", T.LongType()),
    T.StructField("reported_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("run", T.LongType()),
])

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("detected_at", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("run", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("run", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])
