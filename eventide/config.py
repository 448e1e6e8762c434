"""Settings of the activity job, overridable from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

# Fixed values that must equal the reference's for the same results:
# topic names, thresholds, window lengths, slide, watermarks, trigger,
# micro-batch input cap, write chunk sizes, and how many alerts or how much
# time the notifier waits for.
EVENTS_TOPIC = "user_events"
ALERTS_TOPIC = "anomaly_alerts"
DEAD_LETTER_TOPIC = "dead_letter_topic"
ANOMALY_THRESHOLD = 5
Z_THRESHOLD = 3.0
SHORT_WINDOW = "5 seconds"
LONG_WINDOW = "1 minute"
WINDOW_SLIDE = "5 seconds"
SHORT_WATERMARK = "30 seconds"
LONG_WATERMARK = "2 minutes"
PROCESSING_TRIGGER = "1 second"
MAX_OFFSETS_PER_TRIGGER = 1000
RAW_WRITE_BATCH_ROWS = 5000
LEAST_ALERTS = 100
ALERT_DELAY = "1s"


def _flag(text: str) -> bool:
    return text.strip().lower() in ("1", "true", "yes", "on")


def _env(name: str, default, cast=str):
    raw = os.environ.get(name)
    return default if raw is None or raw == "" else cast(raw)


@dataclass(frozen=True)
class WindowSpec:
    """One windowed count: length, slide, allowed lateness and its audit tag."""

    name: str
    length: str
    slide: str
    watermark: str


@dataclass(frozen=True)
class Settings:
    kafka_brokers: str = "kafka:9092"
    events_topic: str = EVENTS_TOPIC
    alerts_topic: str = ALERTS_TOPIC
    dead_letter_topic: str = DEAD_LETTER_TOPIC
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    output_root: str | None = None
    checkpoint_root: str | None = None
    anomaly_threshold: int = ANOMALY_THRESHOLD
    z_threshold: float = Z_THRESHOLD
    trigger: str = PROCESSING_TRIGGER
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    raw_write_batch_rows: int = RAW_WRITE_BATCH_ROWS
    # Alerts the notifier takes in one trigger; unset: all there are.
    alerts_per_trigger: int | None = None
    # The notifier starts a trigger at so many alerts, or after the delay.
    least_alerts: int = LEAST_ALERTS
    alert_delay: str = ALERT_DELAY
    # Folder or table of Parquet users, when they do not come over JDBC, and
    # how often the dimension is read again.
    users_path: str | None = None
    users_refresh_seconds: float = 300.0
    # Where alerts and dead letters go: "json" files or "kafka" topics; and how
    # raw events and keyed rows are stored.
    alert_format: str | None = None
    raw_format: str | None = None
    keyed_format: str = "parquet"
    # Partitions of streaming state: fixed by a query's first run, so a cluster must choose.
    state_partitions: int | None = None
    # Alert only anomalies the insert-ignore table did not hold yet (the
    # reference alerts on every emitted row of every trigger).
    alert_new_only: bool = False
    # Drop raw events whose natural key an earlier batch already stored, as far
    # back in event time as this (the keys of that time are held as state).
    raw_unique_across_batches: bool = True
    raw_unique_within: str = "1 day"
    windows: tuple[WindowSpec, ...] = field(
        default=(
            WindowSpec("5s", SHORT_WINDOW, SHORT_WINDOW, SHORT_WATERMARK),
            WindowSpec("1min", LONG_WINDOW, WINDOW_SLIDE, LONG_WATERMARK),
        )
    )

    @classmethod
    def from_env(cls, **overrides) -> "Settings":
        """Read ``KAFKA_BROKER``-style variables; keyword overrides win."""
        env = {
            "kafka_brokers": _env("KAFKA_BROKER", cls.kafka_brokers),
            "events_topic": _env("KAFKA_TOPIC", cls.events_topic),
            "alerts_topic": _env("KAFKA_ALERT_TOPIC", cls.alerts_topic),
            "dead_letter_topic": _env("KAFKA_DLQ_TOPIC", cls.dead_letter_topic),
            "jdbc_url": _env("JDBC_URL", None),
            "jdbc_user": _env("JDBC_USER", None),
            "jdbc_password": _env("JDBC_PASSWORD", None),
            "output_root": _env("OUTPUT_ROOT", None),
            "checkpoint_root": _env("CHECKPOINT_BASE", None),
            "anomaly_threshold": _env("ANOMALY_THRESHOLD", cls.anomaly_threshold, int),
            "z_threshold": _env("Z_THRESHOLD", cls.z_threshold, float),
            "trigger": _env("PROCESSING_TRIGGER", cls.trigger),
            "max_offsets_per_trigger": _env("MAX_OFFSETS_PER_TRIGGER", cls.max_offsets_per_trigger, int),
            "raw_write_batch_rows": _env("COPY_CHUNK", cls.raw_write_batch_rows, int),
            "alerts_per_trigger": _env("ALERTS_PER_TRIGGER", None, int),
            "least_alerts": _env("LEAST_ALERTS", cls.least_alerts, int),
            "alert_delay": _env("ALERT_DELAY", cls.alert_delay),
            "users_path": _env("USERS_PATH", None),
            "users_refresh_seconds": _env("USERS_REFRESH_SECONDS", cls.users_refresh_seconds, float),
            "alert_format": _env("ALERT_FORMAT", None),
            "raw_format": _env("RAW_FORMAT", None),
            "keyed_format": _env("KEYED_FORMAT", cls.keyed_format),
            "state_partitions": _env("STATE_PARTITIONS", None, int),
            "windows": tuple(replace(w, slide=_env("WINDOW_SLIDE", w.slide)) if w.slide != w.length else w
                             for w in cls.windows),
            "alert_new_only": _env("ALERT_NEW_ONLY", cls.alert_new_only, _flag),
            "raw_unique_across_batches": _env("RAW_UNIQUE_ACROSS_BATCHES", cls.raw_unique_across_batches, _flag),
            "raw_unique_within": _env("RAW_UNIQUE_WITHIN", cls.raw_unique_within),
        }
        known = {f.name for f in fields(cls)}
        env.update({k: v for k, v in overrides.items() if k in known})
        return cls(**env)

    def window(self, name: str) -> WindowSpec:
        for spec in self.windows:
            if spec.name == name:
                return spec
        raise KeyError(name)
