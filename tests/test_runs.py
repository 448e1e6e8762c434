"""Lost checkpoints: run numbers, fencing of replaced jobs, newest-wins."""

import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.config import Settings
from eventide.sinks.outputs import Outputs
from eventide.sinks.runs import Folder, StaleRun, claim_run, fence
from eventide.sources.dimension import fixed
from eventide.sources.streams import file_stream
from eventide.streaming.job import run_until_done, start_queries


def test_a_checkpoint_keeps_its_number(spark):
    root, one, two = (tempfile.mkdtemp(prefix=p) for p in ("out-", "c1-", "c2-"))
    assert claim_run(spark, root, one) == 0 and claim_run(spark, root, one) == 0
    fence(spark, root, 0)
    assert claim_run(spark, root, two) == 1  # another checkpoint for the same outputs
    with pytest.raises(StaleRun):
        fence(spark, root, 0)
    fence(spark, root, 1)
    assert sorted(Folder(spark, f"{root}/_runs").names()) == ["0", "1"]


def write(src, name, events):
    with open(os.path.join(src, name), "w") as f:
        for user, second in events:
            f.write(json.dumps({"user_id": user, "product_id": 1, "action": "view", "device_id": f"d{user}",
                                "timestamp": f"2024-01-01T00:00:{second:02d}.000000"}) + "\n")


def job(spark, src, root, ckpt):
    out = Outputs(spark, root, Settings())
    users = fixed(spark.createDataFrame([(1, "Ann", "EU")], "user_id int, name string, region string"))
    run_until_done(start_queries(spark, file_stream(spark, src), users, out, Settings(), ckpt, available_now=True))
    return out


def test_a_lost_checkpoint_overwrites_nothing(spark):
    src, root, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("src-", "out-", "ckpt-"))
    write(src, "a.json", [(1, 1), (1, 2), (2, 3)])
    out = job(spark, src, root, ckpt)
    assert out.run == 0 and out.stored_raw().count() == 3
    counts = {(r["user_id"], r["event_count"]) for r in out.summary.current("5s").collect()}
    assert counts == {(1, 2), (2, 1)}

    # the checkpoint is lost and the topic has forgotten the first file
    for name in os.listdir(src):
        shutil.move(os.path.join(src, name), os.path.join(root, f"_gone_{name}"))
    write(src, "b.json", [(1, 2), (1, 4), (3, 3)])  # the first is an event that run 0 stored
    lost = tempfile.mkdtemp(prefix="ckpt-")
    out = job(spark, src, root, lost)
    assert out.run == 1
    stored = out.stored_raw()
    assert {(r["run"], r["n"]) for r in stored.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()} == {(0, 3), (1, 2)}
    assert {r["batch_id"] for r in stored.collect()} == {0}  # both runs wrote a batch 0
    letters = spark.read.json(out.path("dead_letters"))
    assert [(r["reason"], r["copies"]) for r in letters.collect()] == [("duplicate_key", 1)]
    # newest wins for users that the new run counted, the others stay
    counts = {(r["user_id"], r["event_count"]) for r in out.summary.current("5s").collect()}
    assert counts == {(1, 2), (2, 1), (3, 1)}
    newest = out.summary.log().filter("source = '5s' AND user_id = 1").select("run", "event_count").collect()
    assert {(r["run"], r["event_count"]) for r in newest} == {(0, 2), (1, 2)}

    # the replaced job, still alive, stops instead of writing
    write(src, "c.json", [(9, 9)])
    with pytest.raises(Exception, match="replaced by a newer one"):
        job(spark, src, root, ckpt)
    assert out.stored_raw().filter("user_id = 9").count() == 0
    spark.streams.resetTerminated()
