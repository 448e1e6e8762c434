"""The deployable job on file sources: users from Parquet that change while it
runs, JSON outputs, required settings, and the tail of its own log."""

import json
import os
import tempfile

import pytest

from eventide import app
from eventide.config import Settings
from eventide.sources.dimension import Dimension
from eventide.sources.streams import file_stream
from eventide.streaming.job import run_until_done


def test_dimension_is_read_again_between_triggers(spark):
    now, names = [0.0], ["Ann"]
    dim = Dimension(lambda: spark.createDataFrame([(1, names[0])], "user_id int, name string"), 60, lambda: now[0])
    first = dim.current()
    names[0] = "Bea"
    now[0] = 59.0
    assert dim.current() is first and dim.version == 1
    now[0] = 61.0
    second = dim.current()
    assert dim.version == 2 and second.first()["name"] == "Bea"
    assert first.first()["name"] == "Ann"  # a trigger that began with the old snapshot keeps it
    fixed = Dimension(lambda: spark.range(1))
    assert fixed.current() is fixed.current()
    dim.release()


def feed(src, name, counts, minute):
    with open(os.path.join(src, name), "w") as f:
        for user, n in counts.items():
            for k in range(n):
                f.write(json.dumps({"user_id": user, "product_id": 1, "action": "view", "device_id": f"d{k}",
                                    "timestamp": f"2024-01-01T00:{minute:02d}:01.{k:06d}"}) + "\n")


def test_job_on_files_and_its_log(spark):
    src, root, users = (tempfile.mkdtemp(prefix=p) for p in ("src-", "out-", "users-"))
    ckpt = tempfile.mkdtemp(prefix="ckpt-")
    settings = Settings(output_root=root, checkpoint_root=ckpt, users_path=f"{users}/u", users_refresh_seconds=0.0,
                        alert_format="json", raw_format="parquet", state_partitions=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def name(text):
        spark.createDataFrame([(1, text, "EU")], "user_id int, name string, region string").write.mode("overwrite").parquet(
            f"{users}/u")

    def run():
        from eventide.streaming.job import start_queries
        outputs, dim = app.outputs_of(spark, settings), app.users_source(spark, settings)
        app.fix_state_partitions(spark, settings)
        queries = start_queries(spark, file_stream(spark, src), dim, outputs, settings,
                                app.checkpoint_root(spark, settings, "job"), available_now=True)
        run_until_done(queries)
        return outputs

    try:
        counts = {1: 40, **{u: 1 for u in range(2, 14)}}
        name("Ann")
        feed(src, "a.json", counts, 1)
        out = run()
        name("Bea")
        feed(src, "b.json", counts, 30)
        run()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    alerts = [json.loads(r["value"]) for r in spark.read.text(out.path("alerts")).collect()]
    assert {(a["window_start"][14:16], a["user_name"]) for a in alerts if a["window_start"].endswith("00")} >= {
        ("01", "Ann"), ("30", "Bea")}

    # the job's own log, page by page, with a cursor that outlives the reader
    log = out.log_records()
    total, seen = log.count(), []
    while page := app.log_tail(spark, settings, settle_seconds=0.0).poll(3):
        assert len(page) <= 3
        seen += page
    assert len(seen) == total
    assert {r["type"] for r in seen} == {"raw_batch", "agg_batch", "anomaly"}
    times = [r["logged_at"] for r in seen]
    assert times == sorted(times)
    feed(src, "c.json", {50: 1}, 31)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    more = app.log_tail(spark, settings, settle_seconds=0.0).poll(100)
    assert more and not {r["payload"] for r in more} & {r["payload"] for r in seen}
    assert app.log_tail(spark, settings, settle_seconds=3600.0).poll(100) == []


def test_required_settings(spark):
    for bad in (Settings(), Settings(output_root="/x", raw_format="jdbc"), Settings(output_root="/x", keyed_format="jdbc")):
        with pytest.raises(SystemExit):
            app.outputs_of(spark, bad)
    assert app.outputs_of(spark, Settings(output_root="/x")).alert_format == "kafka"
    assert app.outputs_of(spark, Settings(output_root="/x", alert_format="json", jdbc_url="jdbc:x")).raw_format == "jdbc"
    with pytest.raises(SystemExit):
        app.users_source(spark, Settings())
    with pytest.raises(SystemExit):
        app.fix_state_partitions(spark, Settings())
