"""Parse fixture: which payloads become events, and why the others do not."""

import json

import pytest

from eventide.functions.parse import classify, parse_events

BASE = {"user_id": 10, "product_id": 1500, "action": "click", "timestamp": "2024-01-01T00:00:01.123456"}


def payload(**changes):
    rec = dict(BASE)
    for k, v in changes.items():
        if v is ...:
            rec.pop(k)
        else:
            rec[k] = v
    return json.dumps(rec)


CASES = [
    ("valid", payload(), None),
    ("fraction of 3 digits", payload(timestamp="2024-01-01T00:00:01.123"), None),
    ("numeric action", payload(action=5), None),
    ("extra field", payload(extra="x"), None),
    ("no fraction", payload(timestamp="2024-01-01T00:00:01"), "invalid_timestamp"),
    ("trailing Z", payload(timestamp="2024-01-01T00:00:01.123456Z"), "invalid_timestamp"),
    ("user_id quoted", payload(user_id="10"), "invalid_user_id"),
    ("user_id 7.5", payload(user_id=7.5), "invalid_user_id"),
    ("user_id above int", payload(user_id=3_000_000_000), "invalid_user_id"),
    ("missing product", payload(product_id=...), "invalid_product_id"),
    ("missing action", payload(action=...), "missing_action"),
    ("malformed", payload()[:-1], "malformed_json"),
    ("json null", "null", "malformed_json"),
    ("top-level array", "[1, 2]", "malformed_json"),
    ("empty", "", "empty_payload"),
    ("null payload", None, "empty_payload"),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(name, value) for name, value, _ in CASES]
    return spark.createDataFrame(rows, "case string, value string")


def test_kept_cases(spark, raw):
    kept = parse_events(raw).collect()
    assert len(kept) == 4
    actions = sorted(r["action"] for r in kept)
    assert actions == ["5", "click", "click", "click"]
    assert all(r["event_time"] == r["timestamp"] for r in kept)


def test_reject_reasons(spark, raw):
    got = {r["value"]: r["reason"] for r in classify(raw).collect()}
    for name, value, reason in CASES:
        assert got[value] == reason, name


def test_timestamp_pattern_keeps_micros(spark, raw):
    row = parse_events(raw.filter("case = 'valid'")).first()
    assert row["timestamp"].microsecond == 123456
