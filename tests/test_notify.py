"""Alert checking, message rendering and the notifier handler."""

import json
import tempfile

from eventide.functions.alerts import MESSAGE_TEMPLATE, decode_alerts, notifications
from eventide.streaming.notify import NotifyHandler

ALERT = {"user_id": 7, "user_name": None, "region": "ASIA", "window_start": "2024-01-01T00:00:00",
         "window_end": "2024-01-01T00:01:00", "event_count": 12, "z_score": 5.5, "severity": "high",
         "detected_at": "2024-01-01T00:00:02.000000"}


def alerts_df(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def test_render_and_filter(spark):
    low = dict(ALERT, severity="low")
    missing = {k: v for k, v in ALERT.items() if k != "z_score"}
    out = notifications(decode_alerts(alerts_df(spark, [ALERT, low, missing]))).collect()
    assert len(out) == 1
    assert out[0]["message"] == (
        "⚠️ Anomaly detected:\nUser: 7 (Unknown)\nRegion: ASIA\nCount: 12\n"
        "Window: 2024-01-01T00:00:00 - 2024-01-01T00:01:00\nZ-score: 5.5\nSeverity: high")
    assert MESSAGE_TEMPLATE.count("%") == 8


def test_schema_check_names_first_missing_key(spark):
    recs = [ALERT, {k: v for k, v in ALERT.items() if k not in ("event_count", "severity")}]
    checks = sorted(r["check"] for r in decode_alerts(alerts_df(spark, recs)).collect())
    assert checks == ["missing_event_count", "valid"]


def test_notify_handler_outputs(spark):
    root = tempfile.mkdtemp(prefix="notify-")
    bad = {k: v for k, v in ALERT.items() if k != "user_id"}
    NotifyHandler(root)(alerts_df(spark, [ALERT, bad]), 0)
    assert spark.read.text(f"{root}/payloads").count() == 2
    assert spark.read.json(f"{root}/messages").count() == 1
    assert [r["check"] for r in spark.read.json(f"{root}/invalid").collect()] == ["missing_user_id"]
