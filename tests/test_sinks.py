"""Keyed tables (upsert / insert-ignore), replay idempotence, handlers."""

import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from eventide.config import Settings, WindowSpec
from eventide.functions.parse import classify
from eventide.operators.merge import insert_ignore, merge_upsert, natural_key_dedup
from eventide.sinks.keyed import KeyedTable
from eventide.sinks.outputs import Outputs
from eventide.sources.dimension import fixed
from eventide.streaming.handlers import RawEventsHandler, WindowBatchHandler, tagged_raw_rows

KEY = ["user_id", "window_start", "window_end"]
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def summary(spark, rows):
    data = [(u, T0 + dt.timedelta(seconds=5 * w), T0 + dt.timedelta(seconds=5 * w + 5), c) for u, w, c in rows]
    return spark.createDataFrame(data, "user_id int, window_start timestamp, window_end timestamp, event_count long")


def as_set(df):
    return {(r["user_id"], r["window_start"], r["event_count"]) for r in df.collect()}


def test_keyed_upsert_and_insert_ignore(spark):
    root = tempfile.mkdtemp(prefix="keyed-")
    up = KeyedTable(spark, f"{root}/up", KEY, keep="last")
    ig = KeyedTable(spark, f"{root}/ig", KEY, keep="first")
    b0 = summary(spark, [(1, 0, 1), (2, 0, 1)])
    b1 = summary(spark, [(1, 0, 3), (3, 1, 1)])
    for t in (up, ig):
        t.write(b0, 0)
        t.write(b1, 1)
    assert {(u, c) for u, _, c in as_set(up.current())} == {(1, 3), (2, 1), (3, 1)}
    assert {(u, c) for u, _, c in as_set(ig.current())} == {(1, 1), (2, 1), (3, 1)}
    before = as_set(up.current())
    up.write(b1, 1)  # replay of batch 1
    assert as_set(up.current()) == before
    assert up.log().count() == 4


def test_merge_functions_match_keyed_semantics(spark):
    target = summary(spark, [(1, 0, 1), (2, 0, 1)])
    source = summary(spark, [(1, 0, 3), (3, 1, 1)])
    assert {(u, c) for u, _, c in as_set(merge_upsert(target, source, KEY))} == {(1, 3), (2, 1), (3, 1)}
    assert {(u, c) for u, _, c in as_set(insert_ignore(target, source, KEY))} == {(1, 1), (2, 1), (3, 1)}
    # idempotent: merging the same source again changes nothing
    once = merge_upsert(target, source, KEY)
    assert as_set(merge_upsert(once, source, KEY)) == as_set(once)


def test_null_device_never_collides(spark):
    rows = [(1, 7, "a", None), (2, 7, "a", None), (3, 7, "a", "d1"), (4, 7, "a", "d1")]
    df = spark.createDataFrame(rows, "event_id long, user_id int, action string, device_id string")
    keys = {k: F.col(k) for k in ("user_id", "action", "device_id")}
    out = natural_key_dedup(df, keys, order_col="event_id", nullable=("device_id",))
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2, 3]
    noted = df.withColumn("note", F.concat(F.lit("n"), F.col("event_id")))  # text outside the key
    out = natural_key_dedup(noted, keys, order_col="event_id", nullable=("device_id",))
    assert sorted((r["event_id"], r["note"]) for r in out.collect()) == [(1, "n1"), (2, "n2"), (3, "n3")]
    assert out.columns == noted.columns


def payload(user, second, device="d", action="view", **more):
    return json.dumps({"user_id": user, "product_id": 1000, "action": action,
                       "timestamp": f"2024-01-01T00:00:{second:02d}.500000", "device_id": device, **more})


def tagged(spark, texts):
    """Rows as the stream tags them without state: every key is new."""
    settings = Settings(raw_unique_across_batches=False)
    return tagged_raw_rows(classify(spark.createDataFrame([(t,) for t in texts], "value string")), settings)


def letters(spark, out):
    return {r["reason"]: r["n"] for r in spark.read.json(out.path("dead_letters")).groupBy("reason").agg(
        F.sum("copies").alias("n")).collect()}


def test_raw_handler_outputs_and_empty_guard(spark):
    import os

    out = Outputs(spark, tempfile.mkdtemp(prefix="raw-"), Settings())
    good, ok = payload(1, 1, "d1", location="x" * 120), payload(2, 2, "d2", action="view\tclick")
    batch = tagged(spark, [good, ok, ok, "{bad"])
    handler = RawEventsHandler(out, Settings())
    handler(batch.limit(0), 0)  # empty: no side effects
    assert not os.path.exists(out.path("user_events"))
    for _ in range(2):  # the second time as a replay
        handler(batch, 1)
        stored = spark.read.parquet(out.path("user_events")).collect()
        assert [r["action"] for r in stored] == ["view click"]  # tab flattened, duplicate dropped
        assert stored[0]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 2)
        assert letters(spark, out) == {"malformed_json": 1, "location_max_100": 1, "duplicate_key": 1}
        log = out.log_records().collect()
        assert [json.loads(r["payload"])["records"] for r in log] == [1]  # observed on the write


def test_rows_without_device_never_collide(spark):
    out = Outputs(spark, tempfile.mkdtemp(prefix="raw-"), Settings())
    handler = RawEventsHandler(out, Settings())
    handler(tagged(spark, [payload(3, 3, None)] * 2), 0)
    handler(tagged(spark, [payload(3, 3, None)]), 1)
    assert out.stored_raw().count() == 3


def test_smallest_product_of_a_key_is_stored(spark):
    out = Outputs(spark, tempfile.mkdtemp(prefix="raw-"), Settings())
    rows = [payload(1, 1, product_id=p) for p in (7, 3, 9, 3)]
    RawEventsHandler(out, Settings())(tagged(spark, rows), 0)
    assert [r["product_id"] for r in out.stored_raw().collect()] == [3]
    found = spark.read.json(out.path("dead_letters"))
    refused = {json.loads(r["row"])["product_id"]: r["copies"] for r in found.collect()}
    assert refused == {3: 1, 7: 1, 9: 1}


def test_refused_rows_behind_the_horizon_are_called_late(spark):
    out = Outputs(spark, tempfile.mkdtemp(prefix="raw-"), Settings())
    settings = Settings(raw_unique_within="10 seconds")
    RawEventsHandler(out, settings)(tagged(spark, [payload(1, 40)]), 0)
    unseen = F.lit(False)  # what the state gives for a key it knows, and for a late one
    again = tagged(spark, [payload(1, 40), payload(2, 5)]).withColumn("first", unseen).distinct()
    RawEventsHandler(out, settings)(again, 1)  # a new handler reads the newest time from the log
    assert letters(spark, out) == {"duplicate_key": 1, "late_event": 1}
    assert out.stored_raw().count() == 1


def test_window_handler_small_batches_never_emit(spark):
    """With n rows in a batch z <= sqrt(n-1): 10 rows cannot pass z > 3, 11 can."""
    root = tempfile.mkdtemp(prefix="agg-")
    out = Outputs(spark, root, Settings())
    users = spark.createDataFrame([(1, "Ann", "EU")], "user_id int, name string, region string")
    spec = WindowSpec("5s", "5 seconds", "5 seconds", "30 seconds")
    handler = WindowBatchHandler(spec, fixed(users), out, Settings())

    def batch(counts):
        rows = [((T0 + dt.timedelta(seconds=5 * i), T0 + dt.timedelta(seconds=5 * i + 5)), i + 1, c)
                for i, c in enumerate(counts)]
        return spark.createDataFrame(rows, "window struct<start: timestamp, end: timestamp>, user_id int, event_count long")

    handler(batch([100] + [1] * 9), 0)
    assert out.anomalies.log().count() == 0
    handler(batch([100] + [1] * 10), 1)
    anomalies = out.anomalies.current().collect()
    assert [(r["user_id"], r["event_count"]) for r in anomalies] == [(1, 100)]
    alert = json.loads(spark.read.text(out.path("alerts")).first()["value"])
    assert alert["user_name"] == "Ann" and alert["severity"] == "medium" and abs(alert["z_score"] - 10 ** 0.5) < 1e-9
    assert alert["window_start"] == "2024-01-01T00:00:00"
    log = out.log_records()
    audits = {r["batch_id"]: json.loads(r["payload"]) for r in log.filter("type = 'agg_batch'").collect()}
    assert [json.loads(r["payload"])["user_id"] for r in log.filter("type = 'anomaly'").collect()] == [1]
    assert audits[1]["records"] == 11 and audits[1]["anomalies"] == 1
    assert audits[0]["anomalies"] == 0
    # stddev 0 with counts above 5: not emitted, no error
    handler(batch([9] * 12), 2)
    assert out.anomalies.current().count() == 1


def test_alert_new_only_skips_known_anomalies(spark):
    root = tempfile.mkdtemp(prefix="agg-new-")
    out = Outputs(spark, root, Settings())
    users = spark.createDataFrame([(1, "Ann", "EU")], "user_id int, name string, region string")
    spec = WindowSpec("5s", "5 seconds", "5 seconds", "30 seconds")
    handler = WindowBatchHandler(spec, fixed(users), out, Settings(alert_new_only=True))
    rows = [((T0 + dt.timedelta(seconds=5 * i), T0 + dt.timedelta(seconds=5 * i + 5)), i + 1, c)
            for i, c in enumerate([100] + [1] * 10)]
    b = spark.createDataFrame(rows, "window struct<start: timestamp, end: timestamp>, user_id int, event_count long")
    handler(b, 0)
    handler(b, 1)  # same anomaly again in a later trigger
    per_batch = {r["batch_id"]: r["n"] for r in spark.read.text(out.path("alerts")).groupBy("batch_id").count()
                 .withColumnRenamed("count", "n").collect()}
    assert per_batch == {0: 1}
    handler(b, 0)  # replay of the first batch still alerts (idempotent overwrite)
    assert spark.read.text(out.path("alerts")).count() == 1
