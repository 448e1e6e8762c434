"""The four queries with the production processing-time trigger (R7), and the
job ending when any one query ends (R9)."""

import json
import os
import tempfile

from eventide.config import Settings
from eventide.sinks.outputs import Outputs
from eventide.sources.dimension import fixed
from eventide.sources.streams import file_stream
from eventide.streaming.job import start_queries


def test_processing_time_queries_and_await_any(spark):
    src, root, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("src-", "out-", "ckpt-"))
    with open(os.path.join(src, "a.json"), "w") as f:
        for s in range(20):
            f.write(json.dumps({"user_id": 1 + s % 3, "product_id": 1000, "action": "view",
                                "timestamp": f"2024-01-01T00:00:{s:02d}.000000", "device_id": f"d{s}"}) + "\n")
        f.write("{broken\n")
    users = spark.createDataFrame([(1, "Ann", "EU")], "user_id int, name string, region string")
    out = Outputs(spark, root, Settings())
    queries = start_queries(spark, file_stream(spark, src), fixed(users), out, Settings(trigger="1 second"), ckpt)
    try:
        assert len(queries) == 4 and all(q.isActive for q in queries)
        for q in queries:
            q.processAllAvailable()
        assert spark.read.parquet(out.path("user_events")).count() == 20
        assert spark.read.parquet(out.archive_path).count() == 20
        assert out.summary.current("5s").groupBy().sum("event_count").first()[0] == 20
        assert out.summary.current("1min").groupBy().sum("event_count").first()[0] == 20 * 12
        assert {r["reason"] for r in spark.read.json(out.path("dead_letters")).collect()} == {"malformed_json"}
        queries[0].stop()
        assert spark.streams.awaitAnyTermination(30)
    finally:
        for q in queries:
            q.stop()
        spark.streams.resetTerminated()
