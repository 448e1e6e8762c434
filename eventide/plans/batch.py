"""Batch queries over the driver's tables, one per operator group.

Each function takes (spark, sf_dir) and returns a lazy DataFrame. Timestamp
outputs are ``timestamp_ntz`` (naive UTC), like the stored ``events.ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ANOMALY_THRESHOLD, LONG_WINDOW, SHORT_WINDOW, WINDOW_SLIDE, Z_THRESHOLD
from ..functions import alerts as A
from ..functions import parse as P
from ..functions.text import flatten_whitespace, store_projection
from ..operators import anomaly as AN
from ..operators.audit import agg_batch_record, raw_batch_record
from ..operators.constraints import split_valid, store_rules, violation_counts
from ..operators.enrich import enrich_users
from ..operators.merge import insert_ignore, merge_upsert, natural_key_dedup
from ..operators.tail import tail_log
from ..operators.windows import flatten_window, window_counts
from ..schemas import RAW_COLUMNS, SUMMARY_KEY
from ..sources.payloads import event_payloads
from ..sources.tables import activity, table, typed_events, users_dimension

DAY = "1 day"
TAIL_CURSOR = "2024-01-15 00:00:00"


# ---------------------------------------------------------------- counts

def counts(spark: SparkSession, sf_dir: str, length: str, slide: str | None = None) -> DataFrame:
    return flatten_window(window_counts(activity(spark, sf_dir), length, slide))


def tumbling_count_5s(spark, sf_dir):
    return counts(spark, sf_dir, SHORT_WINDOW)


def sliding_count_1min(spark, sf_dir):
    return counts(spark, sf_dir, LONG_WINDOW, WINDOW_SLIDE)


def day_counts(spark, sf_dir):
    return counts(spark, sf_dir, DAY)


# ------------------------------------------------------ statistics, grades

def batch_stats(spark, sf_dir):
    return AN.batch_stats(day_counts(spark, sf_dir))


def zscore_1min(spark, sf_dir):
    return AN.with_zscore(sliding_count_1min(spark, sf_dir))


def anomaly_flags_1day(spark, sf_dir):
    scored = AN.with_zscore(day_counts(spark, sf_dir))
    return scored.withColumn("is_anomaly", AN.anomaly_flag(F.col("z_score"), F.col("event_count")))


def anomaly_severity_1day(spark, sf_dir):
    return AN.grade(AN.with_zscore(day_counts(spark, sf_dir)))


def anomalies_1min(spark, sf_dir):
    return AN.detect(sliding_count_1min(spark, sf_dir))


def anomalies_1day(spark, sf_dir):
    return AN.detect(day_counts(spark, sf_dir))


def enriched_anomalies_1min(spark, sf_dir):
    """Flagship: sliding counts -> batch z -> emitted anomalies -> user names.
    The anomalies are filtered before the join, so only they meet the dimension."""
    return enrich_users(anomalies_1min(spark, sf_dir), users_dimension(spark, sf_dir))


def enrich_left_join(spark, sf_dir):
    return enrich_users(tumbling_count_5s(spark, sf_dir), users_dimension(spark, sf_dir))


# ------------------------------------------------------------ alert side

def _day_alerts(spark, sf_dir):
    enriched = enrich_users(anomalies_1day(spark, sf_dir), users_dimension(spark, sf_dir))
    return A.alert_records(enriched, with_clock=False)


def alert_payload(spark, sf_dir):
    return _day_alerts(spark, sf_dir)


def anomaly_documents(spark, sf_dir):
    enriched = enrich_users(anomalies_1day(spark, sf_dir), users_dimension(spark, sf_dir))
    return A.anomaly_documents(enriched, with_clock=False)


def alert_schema_check(spark, sf_dir):
    """All graded 1-day rows as alert text, a share with a required key
    removed by (user_id + event_count) % 7: 0 user_id, 1 z_score, 2 severity."""
    graded = AN.grade(AN.with_zscore(day_counts(spark, sf_dir)))
    k = (F.col("user_id") + F.col("event_count")) % 7
    spoiled = graded.select(
        F.when(k != 0, F.col("user_id")).alias("user_id"),
        F.lit(None).cast("string").alias("user_name"),
        F.lit(None).cast("string").alias("region"),
        A.iso_seconds(F.col("window_start")).alias("window_start"),
        A.iso_seconds(F.col("window_end")).alias("window_end"),
        F.col("event_count"),
        F.when(k != 1, F.col("z_score")).alias("z_score"),
        F.when(k != 2, F.col("severity")).alias("severity"),
    )
    text = spoiled.select(F.to_json(F.struct(*spoiled.columns)).alias("value"))
    checked = A.decode_alerts(text)
    return checked.groupBy("check").agg(F.count(F.lit(1)).alias("n_alerts"))


def alert_message(spark, sf_dir):
    """Alerts through their JSON text, checked, filtered and rendered."""
    alerts = _day_alerts(spark, sf_dir)
    text = A.alert_messages(alerts).select("value")
    return A.notifications(A.decode_alerts(text))


# ------------------------------------------------------- parse and store

def _classified(spark, sf_dir):
    return P.classify(event_payloads(spark, sf_dir))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def parse_events(spark, sf_dir):
    parsed = P.parse_events(event_payloads(spark, sf_dir).select("value"))
    return _ntz(parsed, "timestamp", "event_time")


def dead_letter_split(spark, sf_dir):
    rejects = P.rejected_rows(_classified(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def required_fields_filter(spark, sf_dir):
    """Typed events with fields blanked by event_id rules, then the
    required-field filter (user_id %7, product_id %11, action %13, time %17)."""
    ev = typed_events(spark, sf_dir)
    e = F.col("event_id")
    blanked = ev.select(
        "event_id",
        F.when(e % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(e % 11 != 0, F.col("product_id")).alias("product_id"),
        F.when(e % 13 != 0, F.col("action")).alias("action"),
        F.when(e % 17 != 0, F.col("event_time")).alias("event_time"),
    )
    return P.with_required(blanked)


def raw_store_projection(spark, sf_dir):
    return store_projection(typed_events(spark, sf_dir))


def text_normalise(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", flatten_whitespace(F.col("text")).alias("text"))


def _documents_as_rows(spark, sf_dir):
    """Documents in the stored-event shape: whole text as location, source as
    user_segment, lang as device_type; time from the id."""
    docs = table(spark, sf_dir, "documents")  # one length check per row: not worth a shuffle
    day = F.expr("try_cast(doc_id % 86400 AS int)")
    found = {
        "user_id": F.expr("try_cast(doc_id AS int)"),
        "product_id": F.expr("try_cast(n_chars AS int)"),
        "action": F.col("lang"),
        "timestamp": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=day),
        "device_type": F.col("lang"),
        "location": F.col("text"),
        "user_segment": F.col("source"),
    }
    return docs.select(*(found.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS))


def constraint_violations(spark, sf_dir):
    return violation_counts(_documents_as_rows(spark, sf_dir), store_rules())


def natural_key_dedup_q(spark, sf_dir):
    """The store's key cuts time to seconds, where ``events`` has no
    duplicates; keying on the hour gives the operator duplicates to remove."""
    ev = typed_events(spark, sf_dir).select("event_id", "user_id", "product_id", "action", "timestamp", "device_id")
    keys = {
        "user_id": F.col("user_id"),
        "hour": F.date_trunc("hour", F.col("timestamp")),
        "action": F.col("action"),
        "device_id": F.col("device_id"),
    }
    return natural_key_dedup(ev, keys, order_col="event_id", nullable=("device_id",))


# ---------------------------------------------------------------- merges

def _merge_inputs(spark, sf_dir):
    """All events, each counted by day on exactly one side: even event ids in
    the target, odd ones in the source. Keys of both sides mostly carry
    different counts, so upsert and insert-ignore differ. Both counts are one
    sum (a day of a user has fewer than 2**31 events), so that the two sides
    read the same shuffle of one scan."""
    act = typed_events(spark, sf_dir)
    one = F.when(F.col("event_id") % 2 != 0, F.lit(1 << 32)).otherwise(F.lit(1).cast("long"))
    both = act.groupBy(F.window("event_time", DAY).alias("window"), "user_id").agg(F.sum(one).alias("n"))
    sides = (F.col("n").bitwiseAND((1 << 32) - 1), F.shiftright("n", 32))
    return [flatten_window(both.withColumn("event_count", n)).filter("event_count > 0") for n in sides]


def merge_upsert_q(spark, sf_dir):
    target, source = _merge_inputs(spark, sf_dir)
    return merge_upsert(target, source, SUMMARY_KEY)


def merge_insert_ignore(spark, sf_dir):
    target, source = _merge_inputs(spark, sf_dir)
    return insert_ignore(target, source, SUMMARY_KEY)


# ----------------------------------------------------------------- audit

def agg_batch_audit(spark, sf_dir):
    graded = AN.grade(AN.with_zscore(sliding_count_1min(spark, sf_dir)), ANOMALY_THRESHOLD, Z_THRESHOLD)
    return agg_batch_record(graded, 0, "1min", Z_THRESHOLD, with_clock=False)


def raw_batch_audit(spark, sf_dir):
    good = P.good_rows(_classified(spark, sf_dir))
    valid, _ = split_valid(store_projection(good), store_rules())
    return raw_batch_record(valid, 0, with_clock=False)


def log_tail(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    log = ev.select(F.col("ts").alias("logged_at"), "event_id", F.col("event_type").alias("type"),
                    F.col("props").alias("payload"))
    return tail_log(log, F.lit(TAIL_CURSOR).cast("timestamp_ntz"), n=10, ts_col="logged_at", tiebreak="event_id")
