"""DuckDB SQL for each registered query, over the driver's parquet views."""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         event_type AS action, ts,
         CASE WHEN event_id % 10 <> 0 THEN 'device_' || CAST(CAST(user_id AS INTEGER) AS VARCHAR) END AS device_id
  FROM events)"""

US = """us AS (
  SELECT CAST(CASE WHEN c_custkey % 10 <> 0 THEN c_custkey ELSE -c_custkey END AS INTEGER) AS user_id,
         c_name AS user_name, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def tumbling(name: str, width: str, where: str = "") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{width}' AS window_end,
         user_id, COUNT(*) AS event_count
  FROM ev {where} GROUP BY ALL)"""


SLIDING = """g AS (
  SELECT time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '5 seconds' AS window_start,
         time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '5 seconds' + INTERVAL '1 minute' AS window_end,
         user_id, COUNT(*) AS event_count
  FROM ev, range(12) t(i) GROUP BY ALL)"""

STATS = """st AS (SELECT COUNT(*) AS n, SUM(event_count) AS s1, SUM(event_count * event_count) AS q FROM g),
zz AS (SELECT g.*, CASE WHEN n * q - s1 * s1 > 0
                        THEN (event_count - s1 / n) / (sqrt(n * q - s1 * s1) / n) END AS z_score
       FROM g, st),
sv AS (SELECT *, event_count > 5 OR coalesce(z_score >= 3.0, false) AS is_anomaly,
              CASE WHEN z_score > 5 THEN 'high' WHEN z_score > 3 THEN 'medium' ELSE 'low' END AS severity
       FROM zz),
em AS (SELECT window_start, window_end, user_id, event_count, z_score, severity
       FROM sv WHERE is_anomaly AND severity IN ('high', 'medium'))"""

GOOD = "WHERE event_id % 50 NOT IN (0, 1, 2, 3, 4)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


DAY = tumbling("g", "1 day")
FIVE = tumbling("g", "5 seconds")

ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S')"

ALERTS_DAY = with_(EV, DAY, STATS, US) + f"""
SELECT em.user_id, us.user_name, us.region,
       {ISO.format(c='em.window_start')} AS window_start, {ISO.format(c='em.window_end')} AS window_end,
       em.event_count, em.z_score, em.severity
FROM em LEFT JOIN us USING (user_id)"""

NL = "chr(10)"
MESSAGE = (
    f"'⚠️ Anomaly detected:' || {NL} || 'User: ' || CAST(user_id AS VARCHAR) || ' (' || coalesce(user_name, 'Unknown') || ')' || {NL}"
    f" || 'Region: ' || coalesce(region, 'Unknown') || {NL} || 'Count: ' || CAST(event_count AS VARCHAR) || {NL}"
    f" || 'Window: ' || window_start || ' - ' || window_end || {NL} || 'Z-score: ' || CAST(z_score AS VARCHAR) || {NL}"
    f" || 'Severity: ' || severity"
)

SPOILED_ALERTS = """sp AS (
  SELECT CASE WHEN (user_id + event_count) % 7 <> 0 THEN user_id END AS user_id,
         window_start, window_end, event_count,
         CASE WHEN (user_id + event_count) % 7 <> 1 THEN z_score END AS z_score,
         CASE WHEN (user_id + event_count) % 7 <> 2 THEN severity END AS severity
  FROM sv)"""

RULES = [
    ("user_id_not_null", "doc_id IS NULL"),
    ("product_id_not_null", "n_chars IS NULL"),
    ("action_not_null", "lang IS NULL"),
    ("timestamp_not_null", "doc_id IS NULL"),
    ("action_max_50", "length(lang) > 50"),
    ("device_id_max_50", "false"),
    ("device_type_max_50", "length(lang) > 50"),
    ("location_max_100", "length(text) > 100"),
    ("user_segment_max_50", "length(source) > 50"),
    ("ip_address_max_50", "false"),
]
CONSTRAINTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS rule, CAST(COUNT(*) FILTER (WHERE coalesce({pred}, false)) AS BIGINT) AS violations FROM documents"
    for name, pred in RULES)

MERGE_INPUTS = with_(
    EV,
    tumbling("t", "1 day", "WHERE event_id % 2 = 0"),
    tumbling("s", "1 day", "WHERE event_id % 2 <> 0"),
)

def stream_batches(length: str, starts: int, name: str = "em", watermark: str | None = None) -> list[str]:
    """Per-trigger anomalies of a streamed window count: slice k is one
    micro-batch; it changes every window its events touch, with the
    count of all events of that window up to the end of the slice; statistics
    are per batch. ``starts`` = windows per event (length / 5 s slide). With a
    ``watermark``, a window that ended by the newest time of all earlier slices
    (in milliseconds) less the watermark takes no more events."""
    p = name + "_"
    every = (f"SELECT k, user_id, time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01')"
             f" - i * INTERVAL '5 seconds' AS window_start FROM sl, range({starts}) t(i)")
    if watermark:
        every = f"""SELECT e.*, coalesce(e.window_start + INTERVAL '{length}' <= wm.newest - INTERVAL '{watermark}', false) AS late
        FROM ({every}) e JOIN wm USING (k)"""
    return [
        f"{p}e AS ({every})",
        f"{p}w AS (SELECT k, user_id, window_start FROM {p}e{' WHERE NOT late' if watermark else ''})",
        f"{p}t AS (SELECT DISTINCT k, user_id, window_start FROM {p}w)",
        f"""{p}g AS (SELECT t.k, t.user_id, t.window_start, t.window_start + INTERVAL '{length}' AS window_end,
                COUNT(*) AS event_count
         FROM {p}t t JOIN {p}w w ON w.user_id = t.user_id AND w.window_start = t.window_start AND w.k <= t.k
         GROUP BY ALL)""",
        f"{p}st AS (SELECT k, COUNT(*) AS n, SUM(event_count) AS s1, SUM(event_count * event_count) AS q FROM {p}g GROUP BY k)",
        f"""{p}z AS (SELECT g.*, CASE WHEN n * q - s1 * s1 > 0
                          THEN (event_count - s1 / n) / (sqrt(n * q - s1 * s1) / n) END AS z_score
          FROM {p}g g JOIN {p}st USING (k))""",
        f"""{name} AS (SELECT k, user_id, window_start, window_end, event_count, z_score,
                  CASE WHEN z_score > 5 THEN 'high' WHEN z_score > 3 THEN 'medium' ELSE 'low' END AS severity
          FROM {p}z WHERE event_count > 5 OR coalesce(z_score >= 3.0, false))""",
    ]


STREAM_BASE = [
    EV,
    f"gd AS (SELECT * FROM ev {GOOD})",
    "b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM gd)",
    """sl AS (SELECT gd.*, CAST(floor(date_diff('day', lo, CAST(ts AS DATE))
                / ceil((date_diff('day', lo, hi) + 1) / 4.0)) AS INTEGER) AS k FROM gd, b)""",
]
# The redelivered feed: drawn together in time, with late and repeated deliveries.
REDELIVERED = [
    EV,
    f"""dn AS (SELECT * REPLACE (make_timestamp(lo + (epoch_us(ts) - lo) // 720) AS ts), CAST(ts AS DATE) AS day
             FROM ev, (SELECT min(epoch_us(ts)) AS lo FROM ev))""",
    f"""gd AS (SELECT dn.*, CAST(floor(date_diff('day', d.lo, day) / ceil((date_diff('day', d.lo, d.hi) + 1) / 4.0)) AS INTEGER) AS k0,
              CAST(floor(date_diff('day', d.lo, d.hi) / ceil((date_diff('day', d.lo, d.hi) + 1) / 4.0)) AS INTEGER) AS k9
              FROM dn, (SELECT min(day) AS lo, max(day) AS hi FROM dn) d {GOOD})""",
    """sl AS (SELECT * EXCLUDE (k0, k9, day), unnest(CASE WHEN event_id % 16 = 7 THEN [least(k0 + 1, k9)]
              WHEN event_id % 8 = 5 THEN [k0, least(k0 + 1, k9)] WHEN event_id % 32 = 9 THEN [k0, k0] ELSE [k0] END) AS k
              FROM gd)""",
    """wm AS (SELECT a.k, date_trunc('milliseconds', max(b.ts)) AS newest
              FROM (SELECT DISTINCT k FROM sl) a LEFT JOIN sl b ON b.k < a.k GROUP BY a.k)""",
]
# Per natural key: the first slice that brings it, and of that slice the smallest product.
REDELIVERED_STORE = REDELIVERED + [
    "st AS (SELECT *, date_trunc('second', ts) AS sec FROM sl)",
    """ky AS (SELECT user_id, sec, action, device_id, arg_min(product_id, k * 4294967296 + product_id) AS product_id,
              COUNT(*) AS n FROM st WHERE device_id IS NOT NULL GROUP BY ALL)""",
]

STREAM_ALERT_COLS = f"""e.user_id, {ISO.format(c='e.window_start')} AS window_start, {ISO.format(c='e.window_end')} AS window_end,
       e.event_count, e.z_score, e.severity, us.user_name, us.region"""


def stream_alerts(length: str, starts: int) -> str:
    return with_(*STREAM_BASE, *stream_batches(length, starts), US) + f"""
SELECT {STREAM_ALERT_COLS} FROM em e LEFT JOIN us USING (user_id) WHERE e.severity IN ('high', 'medium')"""


def _audit(name: str, tag: str) -> str:
    p = name + "_"
    return f"""SELECT '{tag}' AS window_type, st.n AS records,
       CAST(COUNT(e.k) FILTER (WHERE e.severity IN ('high', 'medium')) AS BIGINT) AS anomalies,
       st.s1 / st.n AS mean_event_count, sqrt(st.n * st.q - st.s1 * st.s1) / st.n AS stddev_event_count,
       3.0::DOUBLE AS z_threshold
FROM {p}st st LEFT JOIN {name} e USING (k) GROUP BY st.k, st.n, st.s1, st.q"""


STREAM_AGG_AUDIT = with_(*STREAM_BASE, *stream_batches("5 seconds", 1, "em5"),
                         *stream_batches("1 minute", 12, "em60")) + _audit("em5", "5s") + "\nUNION ALL\n" + _audit("em60", "1min")

STREAM_NOTIFICATIONS = with_(*STREAM_BASE, *stream_batches("5 seconds", 1, "em5"),
                             *stream_batches("1 minute", 12, "em60"), US) + f"""
SELECT user_id, window_start, window_end, severity, {MESSAGE} AS message FROM (
  SELECT {STREAM_ALERT_COLS} FROM em5 e LEFT JOIN us USING (user_id)
  UNION ALL
  SELECT {STREAM_ALERT_COLS} FROM em60 e LEFT JOIN us USING (user_id)) a
WHERE severity IN ('high', 'medium')"""


SQL: dict[str, str] = {
    "tumbling_count_5s": with_(EV, FIVE) + "SELECT * FROM g",
    "sliding_count_1min": with_(EV, SLIDING) + "SELECT * FROM g",
    "batch_stats": with_(EV, DAY) + """
SELECT COUNT(*) AS n, SUM(event_count) / COUNT(*) AS mean_event_count,
       sqrt(COUNT(*) * SUM(event_count * event_count) - SUM(event_count) * SUM(event_count)) / COUNT(*) AS stddev_event_count
FROM g""",
    "zscore_1min": with_(EV, SLIDING, STATS) + "SELECT window_start, window_end, user_id, event_count, z_score FROM zz",
    "anomaly_flags_1day": with_(EV, DAY, STATS) + "SELECT window_start, window_end, user_id, event_count, z_score, is_anomaly FROM sv",
    "anomaly_severity_1day": with_(EV, DAY, STATS) + "SELECT * FROM sv",
    "anomalies_1min": with_(EV, SLIDING, STATS) + "SELECT * FROM em",
    "anomalies_1day": with_(EV, DAY, STATS) + "SELECT * FROM em",
    "enriched_anomalies_1min": with_(EV, SLIDING, STATS, US) + "SELECT * FROM em LEFT JOIN us USING (user_id)",
    "enrich_left_join": with_(EV, FIVE, US) + "SELECT * FROM g LEFT JOIN us USING (user_id)",
    "alert_payload": ALERTS_DAY,
    "anomaly_documents": with_(EV, DAY, STATS, US) + f"""
SELECT 'anomaly' AS type, em.user_id, em.event_count,
       {ISO.format(c='em.window_start')} AS window_start, {ISO.format(c='em.window_end')} AS window_end,
       em.z_score, em.severity, us.user_name, us.region
FROM em LEFT JOIN us USING (user_id)""",
    "alert_schema_check": with_(EV, DAY, STATS, SPOILED_ALERTS) + """
SELECT CASE WHEN user_id IS NULL THEN 'missing_user_id'
            WHEN event_count IS NULL THEN 'missing_event_count'
            WHEN window_start IS NULL THEN 'missing_window_start'
            WHEN window_end IS NULL THEN 'missing_window_end'
            WHEN z_score IS NULL THEN 'missing_z_score'
            WHEN severity IS NULL THEN 'missing_severity'
            ELSE 'valid' END AS "check",
       COUNT(*) AS n_alerts
FROM sp GROUP BY 1""",
    "alert_message": "SELECT user_id, window_start, window_end, severity, " + MESSAGE + " AS message FROM (" + ALERTS_DAY + ") a WHERE severity IN ('high', 'medium')",
    "parse_events": with_(EV) + f"""
SELECT user_id, product_id, action, ts AS "timestamp", device_id,
       CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS user_segment, CAST(NULL AS VARCHAR) AS ip_address, ts AS event_time
FROM ev {GOOD}""",
    "dead_letter_split": """
SELECT CASE event_id % 50 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'invalid_timestamp'
            WHEN 2 THEN 'invalid_user_id' WHEN 3 THEN 'missing_action' ELSE 'empty_payload' END AS reason,
       COUNT(*) AS rejected
FROM events WHERE event_id % 50 IN (0, 1, 2, 3, 4) GROUP BY 1""",
    "required_fields_filter": with_(EV) + """
SELECT event_id, user_id, product_id, action, ts AS event_time FROM ev
WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0""",
    "raw_store_projection": with_(EV) + """
SELECT user_id, product_id, action, date_trunc('second', ts) AS "timestamp", device_id,
       CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS user_segment, CAST(NULL AS VARCHAR) AS ip_address
FROM ev""",
    "text_normalise": "SELECT doc_id, replace(replace(text, chr(9), ' '), chr(10), ' ') AS text FROM documents",
    "constraint_violations": CONSTRAINTS,
    "natural_key_dedup": with_(EV) + """
SELECT event_id, user_id, product_id, action, "timestamp", device_id FROM (
  SELECT event_id, user_id, product_id, action, ts AS "timestamp", device_id,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts), action, device_id ORDER BY event_id) AS rn
  FROM ev) d
WHERE rn = 1 OR device_id IS NULL""",
    "merge_upsert": MERGE_INPUTS + "SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (user_id, window_start, window_end)",
    "merge_insert_ignore": MERGE_INPUTS + "SELECT * FROM t UNION ALL SELECT s.* FROM s ANTI JOIN t USING (user_id, window_start, window_end)",
    "agg_batch_audit": with_(EV, SLIDING, STATS) + """
SELECT 'agg_batch' AS type, CAST(0 AS BIGINT) AS batch_id, '1min' AS window_type, COUNT(*) AS records,
       CAST(COUNT(*) FILTER (WHERE is_anomaly AND severity IN ('high', 'medium')) AS BIGINT) AS anomalies,
       SUM(event_count) / COUNT(*) AS mean_event_count,
       sqrt(COUNT(*) * SUM(event_count * event_count) - SUM(event_count) * SUM(event_count)) / COUNT(*) AS stddev_event_count,
       3.0::DOUBLE AS z_threshold
FROM sv""",
    "raw_batch_audit": f"SELECT 'raw_batch' AS type, CAST(0 AS BIGINT) AS batch_id, COUNT(*) AS records FROM events {GOOD}",
    "log_tail": """
SELECT logged_at, event_id, type, payload, max(logged_at) OVER () AS next_cursor FROM (
  SELECT ts AS logged_at, event_id, event_type AS type, props AS payload FROM events
  WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' ORDER BY ts DESC, event_id DESC LIMIT 10) p""",
    "stream_summary_5s": with_(EV, tumbling("g", "5 seconds", GOOD)) + "SELECT * FROM g",
    "stream_anomalies_1min": with_(EV, SLIDING.replace("FROM ev, range(12)", f"FROM (SELECT * FROM ev {GOOD}) ev, range(12)"), STATS) + "SELECT * FROM em",
    "stream_alerts_1min": stream_alerts("1 minute", 12),
    "stream_alerts_5s": with_(*REDELIVERED, *stream_batches("5 seconds", 1, "em", "30 seconds"), US) + f"""
SELECT {STREAM_ALERT_COLS} FROM em e LEFT JOIN us USING (user_id) WHERE e.severity IN ('high', 'medium')""",
    "stream_late_dropped": with_(*REDELIVERED, *stream_batches("5 seconds", 1, "em5", "30 seconds"),
                                 *stream_batches("1 minute", 12, "em60", "2 minutes")) + "\nUNION ALL\n".join(f"""
SELECT CAST(e.k AS BIGINT) AS slice, '{tag}' AS "window", any_value(g.n) AS changed, CAST(any_value(g.s1) AS BIGINT) AS events,
       COUNT(DISTINCT CASE WHEN late THEN (user_id, window_start) END) AS dropped
FROM {name}_e e JOIN {name}_st g USING (k) GROUP BY e.k""" for tag, name in (("5s", "em5"), ("1min", "em60"))),
    "stream_duplicate_letters": with_(*REDELIVERED_STORE) + """
SELECT 'duplicate_key' AS reason, user_id, CAST(SUM(n - 1) AS BIGINT) AS refused FROM ky WHERE n > 1 GROUP BY user_id""",
    "job_log_tail": with_(*REDELIVERED, *stream_batches("5 seconds", 1, "em", "30 seconds")) + f"""
SELECT type, user_id, window_start, event_count, severity, records FROM (
  SELECT k, 'anomaly' AS type, user_id, {ISO.format(c='window_start')} AS window_start, event_count, severity,
         CAST(NULL AS BIGINT) AS records FROM em WHERE severity IN ('high', 'medium')
  UNION ALL SELECT k, 'agg_batch', NULL, NULL, NULL, NULL, n FROM em_st) r
ORDER BY k DESC, type DESC, user_id DESC, window_start DESC LIMIT 10""",
    "stream_notifications": STREAM_NOTIFICATIONS,
    "stream_agg_audit": STREAM_AGG_AUDIT,
    "stream_dead_letters": """
SELECT CASE event_id % 50 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'invalid_timestamp'
            WHEN 2 THEN 'invalid_user_id' WHEN 3 THEN 'missing_action' ELSE 'empty_payload' END AS reason,
       COUNT(*) AS rejected
FROM events WHERE event_id % 50 IN (0, 1, 2, 3, 4) GROUP BY 1""",
    "stream_raw_store": with_(*REDELIVERED_STORE) + """
SELECT user_id, product_id, action, sec AS "timestamp", device_id,
       CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS user_segment, CAST(NULL AS VARCHAR) AS ip_address
FROM (SELECT user_id, product_id, action, sec, device_id FROM ky
      UNION ALL SELECT user_id, product_id, action, sec, device_id FROM st WHERE device_id IS NULL)""",
    "stream_archive_parquet": with_(EV) + f"""
SELECT user_id, product_id, action, ts AS "timestamp", device_id,
       CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS user_segment, CAST(NULL AS VARCHAR) AS ip_address, ts AS event_time
FROM ev {GOOD}""",
    "stream_summary_1min": with_(EV, SLIDING.replace("FROM ev, range(12)", f"FROM (SELECT * FROM ev {GOOD}) ev, range(12)"))
    + "SELECT * FROM g",
    "stream_anomalous_events": with_(*STREAM_BASE, *stream_batches("5 seconds", 1, "em5"),
                                     *stream_batches("1 minute", 12, "em60")) + """
SELECT window_start, window_end, user_id, arg_min(event_count, k) AS event_count
FROM (SELECT * FROM em5 UNION ALL SELECT * FROM em60) e
WHERE severity IN ('high', 'medium') GROUP BY window_start, window_end, user_id""",
}
