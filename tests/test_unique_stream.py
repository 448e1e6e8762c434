"""Uniqueness by state over triggers and restarts, and the plans it needs."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from eventide.config import Settings
from eventide.functions.parse import classify
from eventide.operators.unique import resolve
from eventide.sinks.outputs import Outputs
from eventide.sources.streams import file_stream
from eventide.streaming.handlers import RawEventsHandler, store_order, tagged_raw_rows
from eventide.schemas import RAW_COLUMNS, RAW_NATURAL_KEY


def event(user, minute, device="d", product=1):
    return json.dumps({"user_id": user, "product_id": product, "action": "view", "device_id": device,
                       "timestamp": f"2024-01-01T00:{minute:02d}:00.250000"})


def trigger(spark, src, out, ckpt, settings, name, texts):
    with open(os.path.join(src, name), "w") as f:
        f.write("\n".join(texts) + "\n")
    rows = tagged_raw_rows(classify(file_stream(spark, src)), settings)
    q = (rows.writeStream.outputMode("append").foreachBatch(RawEventsHandler(out, settings))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_state_over_triggers_and_restarts(spark):
    src, root, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("src-", "out-", "ckpt-"))
    settings = Settings(raw_unique_within="10 minutes")
    out = Outputs(spark, root, settings)
    step = lambda name, texts: trigger(spark, src, out, ckpt, settings, name, texts)
    letters = lambda: {(r["reason"], r["batch_id"]): r["n"] for r in spark.read.json(out.path("dead_letters")).groupBy(
        "reason", "batch_id").agg(F.sum("copies").alias("n")).collect()}

    step("a", [event(1, 1), event(1, 1), event(2, 1, None), event(3, 1, product=5), event(3, 1, product=4), "{"])
    assert sorted((r["user_id"], r["product_id"]) for r in out.stored_raw().collect()) == [(1, 1), (2, 1), (3, 4)]
    first = {k: n for k, n in letters().items()}
    assert sorted((reason, n) for (reason, _), n in first.items()) == [("duplicate_key", 2), ("malformed_json", 1)]

    q = step("b", [event(1, 1), event(2, 1, None), event(4, 20)])  # known key; a null never collides; a new key
    assert out.stored_raw().count() == 5
    assert sum(n for (reason, _), n in letters().items() if reason == "duplicate_key") == 3
    assert any(op["operatorName"] == "dedupeWithinWatermark" for p in q.recentProgress for op in p["stateOperators"])

    step("c", [event(5, 1), event(4, 20)])  # the watermark stands at minute 10: too late to know; known
    assert out.stored_raw().filter("user_id = 5").count() == 0
    found = letters()
    assert sum(n for (reason, _), n in found.items() if reason == "late_event") == 1
    assert sum(n for (reason, _), n in found.items() if reason == "duplicate_key") == 4
    # every row that came is stored or lettered
    assert out.stored_raw().count() + sum(found.values()) == 6 + 3 + 2


def test_no_stored_row_is_read(spark):
    """The plan of a micro-batch holds the batch alone, and hashes."""
    texts = [event(u % 3, u % 5) for u in range(50)]
    batch = tagged_raw_rows(classify(spark.createDataFrame([(t,) for t in texts], "value string")),
                            Settings(raw_unique_across_batches=False))
    found = resolve(batch, RAW_NATURAL_KEY, RAW_COLUMNS, store_order(), ("device_id",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "SortAggregate" not in plan and "Window" not in plan
    kinds = found.groupBy("stored").agg(F.count(F.lit(1)).alias("n"), F.sum("refused").alias("refused")).collect()
    assert [(r["stored"], r["n"], r["refused"]) for r in kinds] == [(True, 15, 35)]


def test_a_key_held_by_most_rows_is_one_row_after_the_first_aggregate(spark):
    texts = [event(1, 1)] * 3000 + [event(2, 2)]
    batch = tagged_raw_rows(classify(spark.createDataFrame([(t,) for t in texts], "value string").repartition(8)),
                            Settings(raw_unique_across_batches=False))
    found = resolve(batch, RAW_NATURAL_KEY, RAW_COLUMNS, store_order(), ("device_id",)).collect()
    assert sorted((r["user_id"], r["stored"], r["refused"]) for r in found) == [(1, True, 2999), (2, True, 0)]
