"""Name -> query builder, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import batch as B
from . import streams as S
from .oracle import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "enriched_anomalies_1min": B.enriched_anomalies_1min,
    "tumbling_count_5s": B.tumbling_count_5s,
    "sliding_count_1min": B.sliding_count_1min,
    "batch_stats": B.batch_stats,
    "zscore_1min": B.zscore_1min,
    "anomaly_flags_1day": B.anomaly_flags_1day,
    "anomaly_severity_1day": B.anomaly_severity_1day,
    "anomalies_1min": B.anomalies_1min,
    "anomalies_1day": B.anomalies_1day,
    "enrich_left_join": B.enrich_left_join,
    "alert_payload": B.alert_payload,
    "anomaly_documents": B.anomaly_documents,
    "alert_schema_check": B.alert_schema_check,
    "alert_message": B.alert_message,
    "parse_events": B.parse_events,
    "dead_letter_split": B.dead_letter_split,
    "required_fields_filter": B.required_fields_filter,
    "raw_store_projection": B.raw_store_projection,
    "text_normalise": B.text_normalise,
    "constraint_violations": B.constraint_violations,
    "natural_key_dedup": B.natural_key_dedup_q,
    "merge_upsert": B.merge_upsert_q,
    "merge_insert_ignore": B.merge_insert_ignore,
    "agg_batch_audit": B.agg_batch_audit,
    "raw_batch_audit": B.raw_batch_audit,
    "log_tail": B.log_tail,
    "stream_summary_5s": S.stream_summary_5s,
    "stream_summary_1min": S.stream_summary_1min,
    "stream_anomalous_events": S.stream_anomalous_events,
    "stream_anomalies_1min": S.stream_anomalies_1min,
    "stream_archive_parquet": S.stream_archive_parquet,
    "stream_alerts_1min": S.stream_alerts_1min,
    "stream_alerts_5s": S.stream_alerts_5s,
    "stream_notifications": S.stream_notifications,
    "stream_raw_store": S.stream_raw_store,
    "stream_dead_letters": S.stream_dead_letters,
    "stream_agg_audit": S.stream_agg_audit,
    "stream_duplicate_letters": S.stream_duplicate_letters,
    "stream_late_dropped": S.stream_late_dropped,
    "job_log_tail": S.job_log_tail,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
