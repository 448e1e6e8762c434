"""Golden micro-batches of the watermarked 5-second count (update mode),
restart from a checkpoint, and the stream-equals-batch property."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from eventide.functions.parse import parse_events
from eventide.operators.windows import flatten_window, window_counts
from eventide.sources.streams import file_stream


def event(ts):
    return json.dumps({"user_id": 1, "product_id": 1000, "action": "click", "timestamp": f"2024-01-01T{ts}.000000"})


def write_files(folder, batches, start_index=0):
    """One JSON-lines file per batch, modification times in batch order."""
    base = time.time() - 1000
    for i, times in enumerate(batches, start=start_index):
        path = os.path.join(folder, f"f{i:03d}.json")
        with open(path, "w") as f:
            f.write("".join(event(t) + "\n" for t in times))
        os.utime(path, (base + i, base + i))


def run_counts(spark, src, ckpt):
    seen = []

    def sink(df, batch_id):
        rows = sorted((r["window_start"].strftime("%H:%M:%S"), r["event_count"]) for r in flatten_window(df).collect())
        seen.append((batch_id, rows))

    counts = window_counts(parse_events(file_stream(spark, src, max_files_per_trigger=1)), "5 seconds",
                           watermark="30 seconds")
    q = (counts.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return seen


GOLDEN = [["00:00:01"], ["00:02:00"], ["00:00:02", "00:02:01"], ["00:00:03", "00:02:02", "00:01:31"]]


def test_golden_micro_batches(spark):
    src, ckpt = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="ckpt-")
    write_files(src, GOLDEN)
    seen = dict(run_counts(spark, src, ckpt))
    assert seen[0] == [("00:00:00", 1)]
    assert seen[1] == [("00:02:00", 1)]
    # the late 00:00:02 is still counted: rows are checked against the previous batch's watermark
    assert seen[2] == [("00:00:00", 2), ("00:02:00", 2)]
    # now 00:00:03 is behind the watermark (01:30) and dropped
    assert seen[3] == [("00:01:30", 1), ("00:02:00", 3)]
    assert seen.get(4, []) == []


def test_restart_from_checkpoint_keeps_state(spark):
    src, ckpt = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="ckpt-")
    write_files(src, GOLDEN[:2])
    first = dict(run_counts(spark, src, ckpt))
    assert first[0] == [("00:00:00", 1)]
    write_files(src, GOLDEN[2:], start_index=2)
    second = dict(run_counts(spark, src, ckpt))
    assert min(second) >= 2  # no batch replayed
    # state carried over (00:02:00 reaches 2); the first run ended with a
    # no-data batch that moved the watermark to 00:01:30, so 00:00:02 is late
    assert second[min(second)] == [("00:02:00", 2)]


def test_shared_slide_above_window_fails_analysis(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "user_id int, event_time string") \
        .withColumn("event_time", F.col("event_time").cast("timestamp"))
    with pytest.raises(Exception):
        window_counts(df, "5 seconds", "30 seconds").collect()
    with pytest.raises(Exception):
        window_counts(df, "5 seconds", "30 seconds", watermark="30 seconds").collect()


def test_stream_keys_equal_batch(spark):
    """The streamed 5 s summary equals the batch aggregate of the same rows."""
    from conftest import SF001
    from eventide.plans.streams import stream_summary_5s
    from eventide.sources.payloads import event_payloads

    good = parse_events(event_payloads(spark, SF001).select("value"))
    batch = flatten_window(window_counts(good, "5 seconds")).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "user_id", "event_count")
    streamed = stream_summary_5s(spark, SF001)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_tail_of_the_job_audit_log(spark):
    from conftest import SF001
    from eventide.operators.tail import tail_log
    from eventide.plans.streams import stream_outputs
    from eventide.schemas import LOG_SCHEMA

    out = stream_outputs(spark, SF001)
    log = spark.read.schema(LOG_SCHEMA).json(out.path("logs"))
    types = {r["type"] for r in log.select("type").distinct().collect()}
    assert types == {"raw_batch", "agg_batch", "anomaly"}
    first = log.agg(F.min("logged_at")).first()[0]
    page = tail_log(log, first, n=10).collect()
    assert len(page) == 10
    times = [r["logged_at"] for r in page]
    assert times == sorted(times) and page[0]["next_cursor"] == times[-1]
    assert times[-1] == log.agg(F.max("logged_at")).first()[0]
