"""A user holding a third of all events: results stay exact and the hot key
is combined map-side (no task receives the hot user's raw rows)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import anomaly as AN
from eventide.operators.merge import natural_key_dedup
from eventide.operators.windows import flatten_window, window_counts
from eventide.sources.jdbc import with_created_default
from oracle_compare import compare, duck

HOT = "CASE WHEN event_id % 3 = 0 THEN 10 ELSE CAST(user_id AS INTEGER) END"


def skewed(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    return ev.select("event_id", F.expr(HOT).alias("user_id"), F.col("ts").alias("event_time"),
                     F.col("event_type").alias("action"))


def test_sliding_counts_with_hot_user(spark):
    counts = flatten_window(window_counts(skewed(spark), "1 minute", "5 seconds"))
    sql = f"""
    SELECT time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '5 seconds' AS window_start,
           time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '5 seconds' + INTERVAL '1 minute' AS window_end,
           {HOT} AS user_id, COUNT(*) AS event_count
    FROM events, range(12) t(i) GROUP BY ALL"""
    problems, n = compare(counts, duck(SF01), sql)
    assert not problems, problems
    plan = AN.with_zscore(counts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_dedup_with_hot_key(spark):
    ev = skewed(spark).withColumn("hour", F.date_trunc("hour", "event_time"))
    keys = {"user_id": F.col("user_id"), "hour": F.col("hour")}
    out = natural_key_dedup(ev, keys, order_col="event_id")
    sql = f"""SELECT min(event_id) FROM events GROUP BY {HOT}, date_trunc('hour', ts)"""
    want = {r[0] for r in duck(SF01).execute(sql).fetchall()}
    assert {r["event_id"] for r in out.collect()} == want
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_created_at_default(spark):
    users = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None)], "user_id int, created_at timestamp")
    rows = {r["user_id"]: r["created_at"] for r in with_created_default(users).collect()}
    assert rows[1] == dt.datetime(2024, 1, 1) and rows[2] is not None
