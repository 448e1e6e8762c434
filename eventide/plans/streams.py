"""Stream queries over the driver's tables.

``events`` is turned into event text (with the parser's reject cases) and fed to
the streaming job in slices: each slice is appended to the source folder by one
Spark write, then the four queries run with an ``availableNow`` trigger and
stop. The next slice restarts them from their checkpoints, so state, watermarks,
update output and keyed upserts carry across micro-batches and restarts. Each
slice is one data micro-batch, so per-batch results are known in closed form.

Two feeds are run. The *ordered* feed gives whole days in time order, so nothing
is late and the end state equals the batch result. The *redelivered* feed draws
time together, so that windows of seconds fill, and delivers as an unreliable
producer does: some events come a slice later, some a second time in the next
slice or in the same one.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import anomaly as AN
from ..operators.tail import tail_log
from ..schemas import DOCUMENT_SCHEMA, LETTER_SCHEMA, MESSAGE_SCHEMA
from ..session import scratch_path, use_utc
from ..sinks.outputs import Outputs
from ..sinks.runs import Folder
from ..sources.dimension import fixed
from ..sources.payloads import dense_events, event_payloads, payloads_of
from ..sources.streams import file_stream
from ..sources.tables import table, users_dimension
from ..streaming.job import run_until_done, start_queries
from ..streaming.notify import start_notifier

SLICES = 4

#: Events of a run for each partition of its streams' state. The aggregate of a
#: task holds a row for each window of a slice's events in its partition, so
#: this bounds a task's memory whatever the size of the table.
STATE_EVENTS = 400_000

#: Text that one task parses: its map-side aggregate holds the windows of that much.
PARSED_BYTES = "32m"

#: State lies on local disk behind bounded memory, one bound for all stores of an
#: executor. Nobody asks for the number of rows, whose upkeep is a read more for
#: each row written or evicted.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

Feed = Callable[[SparkSession, str, int], Iterator[DataFrame]]


def day_slices(payloads: DataFrame, n: int, day=None) -> list[tuple]:
    """Up to n consecutive [first_day, next_first_day) ranges of whole days,
    ceil(days / n) days each, covering the table (one aggregate row)."""
    day = F.to_date("event_time") if day is None else day
    lo, hi = payloads.agg(F.min(day), F.max(day)).first()
    if lo is None:
        return []
    days = (hi - lo).days + 1
    width = -(-days // n)
    starts = [lo + dt.timedelta(days=width * i) for i in range(n) if width * i < days]
    return list(zip(starts, starts[1:] + [None]))


def ordered_feed(spark: SparkSession, sf_dir: str, slices: int = SLICES) -> Iterator[DataFrame]:
    payloads = event_payloads(spark, sf_dir)
    day = F.to_date("event_time")
    for lo, hi in day_slices(payloads, slices):
        part = payloads.filter(day >= F.lit(lo))
        yield part if hi is None else part.filter(day < F.lit(hi))


def redelivered_feed(spark: SparkSession, sf_dir: str, slices: int = SLICES) -> Iterator[DataFrame]:
    """Deliveries by event id: 7 modulo 16 comes a slice later, 5 modulo 8
    comes again in the next slice, 9 modulo 32 comes twice at once. The last
    slice has no next one."""
    payloads = payloads_of(dense_events(spark, sf_dir))
    days = day_slices(payloads, slices, F.col("day"))
    own = F.lit(0)
    for k, (lo, _) in enumerate(days):
        own = F.when(F.col("day") >= F.lit(lo), k).otherwise(own)
    late = F.least(own + 1, F.lit(len(days) - 1))
    e = F.col("event_id")
    at = (F.when(e % 16 == 7, F.array(late)).when(e % 8 == 5, F.array(own, late))
          .when(e % 32 == 9, F.array(own, own)).otherwise(F.array(own)))
    delivered = payloads.select("value", F.explode(at).alias("slice"))
    for k in range(len(days)):
        yield delivered.filter(F.col("slice") == k)


def run_stream(spark: SparkSession, sf_dir: str, settings: Settings | None = None, slices: int = SLICES,
               feed: Feed = ordered_feed) -> Outputs:
    """Run the streaming job over a feed slice by slice; returns where it wrote."""
    settings = settings or Settings()
    base = scratch_path(spark, "stream")
    outputs = Outputs(spark, f"{base}/out", settings)
    src, ckpt = f"{base}/source", f"{base}/checkpoints"
    users = fixed(users_dimension(spark, sf_dir))
    spark.createDataFrame([], "value string").write.mode("overwrite").text(src)
    source = spark.readStream.format("text").load(src)
    processing, outputs.progress = 0.0, []
    for k, part in enumerate(feed(spark, sf_dir, slices)):
        part.select("value").write.mode("append").text(src)
        t0 = time.perf_counter()
        queries = start_queries(spark, source, users, outputs, settings, ckpt, available_now=True)
        run_until_done(queries)
        processing += time.perf_counter() - t0
        # a few numbers a trigger, as Spark reports them
        outputs.progress += [(k, q.name, sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress
                                             for op in p["stateOperators"])) for q in queries]
    users.release()
    # the notifier consumes the alert log the job wrote, as it would the topic
    t0 = time.perf_counter()
    alerts = file_stream(spark, outputs.path("alerts") + "/source=*/run=*/batch_id=*")
    start_notifier(alerts, outputs.path("notifications"), f"{ckpt}/notify", available_now=True).awaitTermination()
    processing += time.perf_counter() - t0
    outputs.processing_seconds = processing  # time spent in the streaming queries
    return outputs


_RUNS: dict[tuple, Outputs] = {}
_RUNS_LOCK = threading.Lock()


def table_state(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> tuple:
    """Files, sizes and times of the tables: a changed table is run again."""
    found = []
    for name in names:
        folder = Folder(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        found += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime())
                        for s in folder._fs.listStatus(folder.path))
    return tuple(found)


def state_partitions(events: int, cores: int) -> int:
    """One for each core, and as many as keep a partition's share of the events bounded."""
    return max(cores, -(-events // STATE_EVENTS))


def stream_session(spark: SparkSession, sf_dir: str) -> SparkSession:
    """A session for a run: state that does not live on the heap (unless the
    caller chose a store) in partitions by the size of the table."""
    own = spark.newSession()
    for name, value in STATE_STORE.items():
        own.conf.set(name, value)
    for name in ("spark.sql.session.timeZone", "spark.checkpoint.dir", PROVIDER):
        if (value := spark.conf.get(name, None)) is not None and own.conf.isModifiable(name):
            own.conf.set(name, value)
    events = table(spark, sf_dir, "events").count()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions(events, spark.sparkContext.defaultParallelism)))
    own.conf.set("spark.sql.files.maxPartitionBytes", PARSED_BYTES)
    return own


def stream_outputs(spark: SparkSession, sf_dir: str, feed: Feed = ordered_feed) -> Outputs:
    """One run per application, feed and state of the tables; the stream keys
    read its outputs.

    Streaming plans get no adaptive coalescing and the state keeps the
    partition count of its first run, so the run has a session of its own (see
    ``stream_session``)."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, feed.__name__,
           table_state(spark, sf_dir, ("events", "customer", "nation", "region")))
    with _RUNS_LOCK:
        if key not in _RUNS:
            _RUNS[key] = run_stream(stream_session(spark, sf_dir), sf_dir, feed=feed)
        found = _RUNS[key]
    out = Outputs(spark, found.root, found.settings, run=found.run)  # to be read in the caller's session
    out.progress = found.progress
    return out


def redelivered_outputs(spark: SparkSession, sf_dir: str) -> Outputs:
    return stream_outputs(spark, sf_dir, redelivered_feed)


def _ntz(*cols):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


def stream_summary_5s(spark, sf_dir):
    cur = stream_outputs(spark, sf_dir).summary.current("5s")
    return cur.select(*_ntz("window_start", "window_end"), "user_id", "event_count")


def stream_summary_1min(spark, sf_dir):
    cur = stream_outputs(spark, sf_dir).summary.current("1min")
    return cur.select(*_ntz("window_start", "window_end"), "user_id", "event_count")


def stream_anomalies_1min(spark, sf_dir):
    return AN.detect(stream_summary_1min(spark, sf_dir))


def stream_anomalous_events(spark, sf_dir):
    """The stored insert-ignore table of both window queries: the first count
    emitted for each key."""
    cur = stream_outputs(spark, sf_dir).anomalies.current()
    return cur.select(*_ntz("window_start", "window_end"), "user_id", "event_count")


def stream_archive_parquet(spark, sf_dir):
    out = stream_outputs(spark, sf_dir)
    arch = spark.read.parquet(out.archive_path)
    return arch.select("user_id", "product_id", "action", *_ntz("timestamp"), "device_id", "device_type",
                       "location", "user_segment", "ip_address", *_ntz("event_time"))


def _stream_alerts(spark, out, tag):
    """Anomalies as a window query emitted them, trigger by trigger: each
    batch graded against the statistics of the rows it changed."""
    docs = spark.read.schema(DOCUMENT_SCHEMA).json(out.path("documents")).filter(F.col("source") == tag)
    return docs.select("user_id", "window_start", "window_end", "event_count", "z_score", "severity",
                       "user_name", "region")


def stream_alerts_1min(spark, sf_dir):
    return _stream_alerts(spark, stream_outputs(spark, sf_dir), "1min")


def stream_alerts_5s(spark, sf_dir):
    """From the redelivered feed: its dense windows do hold outliers, and late
    rows change none of them."""
    return _stream_alerts(spark, redelivered_outputs(spark, sf_dir), "5s")


def stream_notifications(spark, sf_dir):
    """Messages the notifier rendered from the alert log of both windows."""
    out = stream_outputs(spark, sf_dir)
    msgs = spark.read.schema(MESSAGE_SCHEMA).json(out.path("notifications") + "/messages")
    return msgs.select("user_id", "window_start", "window_end", "severity", "message")


def stream_raw_store(spark, sf_dir):
    """Events the raw query stored from the redelivered feed (9 columns,
    one-line text, whole seconds), unique on the natural key over all triggers
    and restarts."""
    raw = redelivered_outputs(spark, sf_dir).stored_raw()
    return raw.select("user_id", "product_id", "action", *_ntz("timestamp"), "device_id", "device_type",
                      "location", "user_segment", "ip_address")


def _letters(spark, out) -> DataFrame:
    return spark.read.schema(LETTER_SCHEMA).json(out.path("dead_letters"))


def stream_dead_letters(spark, sf_dir):
    """Rejected rows per reason, over all triggers of the raw query."""
    dl = _letters(spark, stream_outputs(spark, sf_dir))
    return dl.groupBy("reason").agg(F.sum("copies").alias("rejected"))


def stream_duplicate_letters(spark, sf_dir):
    """Rows whose key was stored before, by user and reason, from the redelivered feed."""
    dl = _letters(spark, redelivered_outputs(spark, sf_dir)).filter(F.col("reason").isin("duplicate_key", "late_event"))
    user = F.get_json_object("row", "$.user_id").cast("int")
    return dl.groupBy("reason", user.alias("user_id")).agg(F.sum("copies").alias("refused"))


def stream_late_dropped(spark, sf_dir):
    """Per window query and slice of the redelivered feed: windows of users
    that changed, and those that only late rows would have changed (Spark's
    count of rows dropped by the watermark, taken after partial aggregation)."""
    out = redelivered_outputs(spark, sf_dir)
    dropped = spark.createDataFrame(out.progress, "slice long, query string, dropped long").filter(
        F.col("query").startswith("agg_")).select("slice", F.substring("query", 5, 9).alias("window"), "dropped")
    log = out.summary.log()
    # each slice is one data batch of each query; the batches between only move the watermark
    batches = log.select("source", "batch_id").distinct()
    earlier = batches.select(F.col("source").alias("_s"), F.col("batch_id").alias("_b"))
    nth = batches.join(earlier, (F.col("_s") == F.col("source")) & (F.col("_b") < F.col("batch_id")), "left").groupBy(
        "source", "batch_id").agg(F.count("_b").alias("slice"))
    changed = log.groupBy("source", "batch_id").agg(F.count(F.lit(1)).alias("changed"),
                                                    F.sum("event_count").alias("events")).join(nth, ["source", "batch_id"])
    return dropped.join(changed.select("slice", F.col("source").alias("window"), "changed", "events"), ["slice", "window"])


def job_log_tail(spark, sf_dir):
    """The newest ten records of the 5-second query in the job's own log, which
    holds raw_batch, agg_batch and anomaly records."""
    log = redelivered_outputs(spark, sf_dir).log_records().filter(F.col("source") == "5s")
    payload = F.from_json("payload", "user_id int, window_start string, event_count long, severity string, records long")
    typed = log.select("logged_at", "type", payload.alias("p")).select("logged_at", "type", "p.*")
    page = tail_log(typed, F.lit("1970-01-01").cast("timestamp"), n=10,
                    tiebreak=["type", "user_id", "window_start"])
    return page.select("type", "user_id", "window_start", "event_count", "severity", "records")


def stream_agg_audit(spark, sf_dir):
    """agg_batch records the window queries logged, one per data trigger."""
    log = stream_outputs(spark, sf_dir).log_records().filter(F.col("type") == "agg_batch")
    rec = F.from_json("payload", "window_type string, records long, anomalies long, mean_event_count double, "
                                 "stddev_event_count double, z_threshold double")
    return log.select(rec.alias("r")).select("r.*")
