"""Settings, Kafka option maps and the JDBC merge statement."""

from eventide.config import Settings
from eventide.sinks.jdbc import commit_batch, merge_statement, record_statement, write_options
from eventide.sinks.kafka import sink_options
from eventide.sources.streams import alert_options, event_options, kafka_source_options


def test_settings_from_env(monkeypatch):
    monkeypatch.setenv("KAFKA_BROKER", "b:1")
    monkeypatch.setenv("Z_THRESHOLD", "4.5")
    monkeypatch.setenv("ALERT_NEW_ONLY", "true")
    s = Settings.from_env(anomaly_threshold=7)
    assert s.kafka_brokers == "b:1" and s.z_threshold == 4.5 and s.anomaly_threshold == 7
    assert s.alert_new_only and s.raw_unique_across_batches
    assert s.window("1min").slide == "5 seconds" and s.window("5s").watermark == "30 seconds"
    assert Settings().z_threshold == 3.0 and Settings().max_offsets_per_trigger == 1000


def test_caps_and_slide_from_env(monkeypatch):
    assert Settings.from_env().alerts_per_trigger is None  # the notifier takes all there is
    for name, value in {"MAX_OFFSETS_PER_TRIGGER": "50000", "COPY_CHUNK": "100", "ALERTS_PER_TRIGGER": "7",
                        "STATE_PARTITIONS": "64", "WINDOW_SLIDE": "10 seconds"}.items():
        monkeypatch.setenv(name, value)
    s = Settings.from_env()
    assert (s.max_offsets_per_trigger, s.raw_write_batch_rows, s.alerts_per_trigger, s.state_partitions) == (50000, 100, 7, 64)
    assert s.window("1min").slide == "10 seconds" and s.window("5s").slide == "5 seconds"


def test_kafka_options():
    opts = kafka_source_options(Settings(), "user_events", 1000)
    assert opts == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "user_events",
                    "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000"}
    assert sink_options(Settings(), "anomaly_alerts")["topic"] == "anomaly_alerts"


def test_merge_statement_and_jdbc_options():
    up = merge_statement("s", "st", ["user_id", "window_start"], ["event_count"], keep="last")
    assert "WHEN MATCHED THEN UPDATE SET event_count = s.event_count" in up
    ig = merge_statement("s", "st", ["user_id"], ["event_count"], keep="first")
    assert "WHEN MATCHED" not in ig and "WHEN NOT MATCHED THEN INSERT" in ig
    opts = write_options(Settings(jdbc_url="jdbc:x://h/db", jdbc_user="u", jdbc_password="p"))
    assert opts["batchsize"] == "5000" and opts["user"] == "u"


def test_notifier_waits_for_alerts_or_time_and_has_no_ceiling():
    opts = alert_options(Settings())
    assert opts["minOffsetsPerTrigger"] == "100" and opts["maxTriggerDelay"] == "1s"
    assert "maxOffsetsPerTrigger" not in opts
    assert alert_options(Settings(alerts_per_trigger=7))["maxOffsetsPerTrigger"] == "7"
    assert "minOffsetsPerTrigger" not in event_options(Settings())


class Database:
    """Stands in for a connection: records statements, knows committed batches."""

    def __init__(self):
        self.batches, self.log = set(), []

    def setAutoCommit(self, on):
        assert not on

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        self.log.append(sql.split()[0])
        if sql.startswith("INSERT INTO committed_batches"):
            new = sql not in self.batches
            self.batches.add(sql)
            return int(new)
        if "broken" in sql:
            raise RuntimeError("no such table")
        return 1

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        pass


def test_a_batch_is_committed_once(spark):
    rows, db, staged = spark.range(1).withColumnRenamed("id", "user_id"), Database(), []
    stage = lambda r, s, name: staged.append(name)
    commit = lambda batch, run=0, table="t": commit_batch(
        rows, Settings(), table, ["user_id"], "raw", run, batch, "first", connection=db, staged=stage)
    assert commit(0) and not commit(0) and commit(0, run=1) and commit(1)
    assert db.log.count("MERGE") == 3 and db.log.count("commit") == 4 and staged == ["raw_staging"] * 4
    import pytest
    with pytest.raises(RuntimeError):
        commit(2, table="broken")
    assert db.log[-1] == "rollback"
    assert "WHERE NOT EXISTS" in record_statement("raw", 1, 2)
