"""What bounds a task's memory when the stream's tables grow."""

import tempfile

from pyspark.sql import functions as F

from eventide.plans import streams as S

STORE = "spark.sql.streaming.stateStore."


def events_folder(spark, n):
    folder = tempfile.mkdtemp(prefix="events-")
    spark.range(n).select(F.col("id").alias("event_id")).write.parquet(f"{folder}/events.parquet")
    return folder


def test_state_partitions_follow_the_events(spark, monkeypatch):
    assert S.state_partitions(0, 8) == 8 and S.state_partitions(8 * S.STATE_EVENTS, 8) == 8
    assert S.state_partitions(8 * S.STATE_EVENTS + 1, 8) == 9
    monkeypatch.setattr(S, "STATE_EVENTS", 10)
    own = S.stream_session(spark, events_folder(spark, 301))
    assert own.conf.get("spark.sql.shuffle.partitions") == "31"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # the caller's session stays as it is


def test_state_is_on_disk_unless_the_caller_chose_a_store(spark):
    folder = events_folder(spark, 5)
    own = S.stream_session(spark, folder)
    assert own.conf.get(S.PROVIDER).endswith("RocksDBStateStoreProvider")
    assert own.conf.get(f"{STORE}rocksdb.boundedMemoryUsage") == "true"
    chosen = spark.newSession()
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    chosen.conf.set(S.PROVIDER, heap)
    assert S.stream_session(chosen, folder).conf.get(S.PROVIDER) == heap
