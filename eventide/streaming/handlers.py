"""foreachBatch handlers. Each persists its micro-batch once, fans it out to
every output as parallel Spark writes, and lets failures propagate, so the
batch is retried from the checkpoint instead of being marked done."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import Settings, WindowSpec
from ..functions import alerts as A
from ..functions.text import store_projection
from ..operators import anomaly as AN
from ..operators.audit import agg_record_of, as_log_records, emitted_count, raw_record_of
from ..operators.constraints import first_violation, store_rules
from ..operators.enrich import enrich_users
from ..operators.unique import resolve, with_firsts
from ..operators.windows import flatten_window
from ..schemas import RAW_COLUMNS, RAW_NATURAL_KEY, SUMMARY_KEY
from ..sinks.outputs import Outputs
from ..sinks.runs import version
from ..sources.dimension import Dimension

#: Why the store refuses a row that is well formed.
DUPLICATE_KEY = "duplicate_key"
LATE_EVENT = "late_event"


def run_all(*writes) -> None:
    """Independent writes of one persisted batch as concurrent Spark jobs;
    the first failure is raised (and the batch retried)."""
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(w) for w in writes]:
            f.result()


def dead_letters(rejects: DataFrame, batch_id: int) -> DataFrame:
    """reason, batch_id, the row as text, how many copies of it there were, and
    the time it was reported, from rows with ``reason``, ``row`` and ``copies``."""
    return rejects.select("reason", F.lit(int(batch_id)).cast("long").alias("batch_id"), "row",
                          F.col("copies").cast("long").alias("copies"), F.current_timestamp().alias("reported_at"))


def store_row_text(df: DataFrame) -> Column:
    """A stored row as JSON text (null fields stay as keys)."""
    return A.to_json_value(df, RAW_COLUMNS)


def raw_rows(classified: DataFrame) -> DataFrame:
    """Classified text -> the stored columns, ``reason`` (of the parser, else
    of the store's rules), the rejected ``row`` as text, and event_time."""
    flat = classified.select("reason", "value", "data.*")
    rows = store_projection(flat, F.col("reason"), F.col("value"), F.col("timestamp").alias("event_time"))
    reason = F.coalesce(F.col("reason"), first_violation(store_rules()))
    row = F.when(F.col("reason").isNotNull(), F.col("value")).when(reason.isNotNull(), store_row_text(rows))
    return rows.select(*RAW_COLUMNS, reason.alias("reason"), row.alias("row"), "event_time")


def tagged_raw_rows(classified: DataFrame, settings: Settings) -> DataFrame:
    """``raw_rows`` with ``first`` rows of natural keys that are new to the
    stream (all of them, where uniqueness across batches is switched off)."""
    rows = raw_rows(classified)
    fits = F.col("reason").isNull()
    if settings.raw_unique_across_batches:
        return with_firsts(rows, fits, RAW_NATURAL_KEY, ("device_id",), "event_time", settings.raw_unique_within)
    return rows.select("*", F.explode(F.when(fits & F.col("device_id").isNotNull(), F.array(F.lit(False), F.lit(True)))
                                      .otherwise(F.array(F.lit(False)))).alias("first"))


def store_order() -> Column:
    """Which row of a natural key is stored: the smallest product, then the
    smallest hash of the other columns, as one number of fixed width."""
    others = [c for c in RAW_COLUMNS if c not in (*RAW_NATURAL_KEY, "product_id")]
    return (F.col("product_id").cast("decimal(10,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)")
            + F.xxhash64(*others).cast("decimal(20,0)"))


class RawEventsHandler:
    """Tagged raw rows -> stored rows, dead letters and a raw_batch record."""

    def __init__(self, outputs: Outputs, settings: Settings):
        self.outputs, self.settings = outputs, settings
        self._newest: dict[int, dt.datetime | None] = {}  # by batch: the newest event time before it

    def _newest_before(self, batch_id: int) -> dt.datetime | None:
        """Newest event time of this run's earlier batches, from which the
        stream's watermark counts; read from the log once after a restart."""
        if batch_id not in self._newest:
            log = self.outputs.log_records().filter(
                (F.col("type") == "raw_batch") & (F.col("run") == self.outputs.run) & (F.col("batch_id") < batch_id))
            newest = F.from_json("payload", "newest timestamp").getField("newest")
            self._newest = {batch_id: log.agg(F.max(newest)).first()[0]}
        return self._newest[batch_id]

    def _known_before(self, span) -> DataFrame | None:
        """Keys that earlier runs stored on the batch's days. Only a run whose
        checkpoint was lost has any: its state began empty."""
        if not self.outputs.run or self.outputs.raw_format == "jdbc":
            return None
        return self.outputs.stored_raw().filter(
            F.col("event_date").between(F.lit(span["first_day"]), F.lit(span["last_day"]))
            & (F.col("run") < self.outputs.run))

    def _refused_reason(self, batch_id: int) -> Column:
        """A key that is not new was stored before; or it lies so far back that
        the stream no longer knows (to the second)."""
        newest = self._newest_before(batch_id)
        if newest is None or not self.settings.raw_unique_across_batches:
            return F.lit(DUPLICATE_KEY)
        horizon = F.lit(newest) - F.expr(f"INTERVAL {self.settings.raw_unique_within}")
        return F.when(F.col("timestamp") < F.date_trunc("second", horizon), LATE_EVENT).otherwise(DUPLICATE_KEY)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        self.outputs.check_run()
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fits = F.col("reason").isNull()
            in_key = fits & F.col("device_id").isNotNull() & ~F.col("first")
            day = F.to_date("timestamp")
            span = batch.agg(F.count(F.lit(1)).alias("n"), F.max(F.when(in_key, F.col("event_time"))).alias("newest"),
                             F.min(day).alias("first_day"), F.max(day).alias("last_day")).first()
            if not span["n"]:
                return
            resolved = resolve(batch.filter(fits), RAW_NATURAL_KEY, RAW_COLUMNS, store_order(), ("device_id",),
                               self._known_before(span)).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                valid = resolved.filter("stored").select(*RAW_COLUMNS)
                refused = resolved.filter("refused > 0").select(
                    self._refused_reason(batch_id).alias("reason"), store_row_text(resolved).alias("row"),
                    F.col("refused").alias("copies"))
                rejects = batch.filter(~fits).select("reason", "row", F.lit(1).alias("copies"))
                letters = dead_letters(rejects.unionByName(refused), batch_id)
                run_all(lambda: self._store(valid, batch_id, span["newest"]),
                        lambda: self.outputs.write_dead_letters(letters, "raw", batch_id))
            finally:
                resolved.unpersist()
            before = self._newest_before(batch_id)
            times = [t for t in (before, span["newest"]) if t is not None]
            self._newest = {batch_id: before, batch_id + 1: max(times, default=None)}
        finally:
            batch.unpersist()

    def _store(self, valid: DataFrame, batch_id: int, newest: dt.datetime | None) -> None:
        """Write the rows; the audit record counts them as they are written."""
        written = Observation(f"raw_{batch_id}")
        self.outputs.write_raw(valid.observe(written, F.count(F.lit(1)).alias("records")), batch_id)
        count = valid.sparkSession.createDataFrame([(written.get["records"], newest)], "records long, newest timestamp")
        self.outputs.write_log(as_log_records(raw_record_of(count, batch_id)), "raw", batch_id)


class WindowBatchHandler:
    """Changed (window, user) counts of one trigger -> summary upsert, graded
    anomalies (insert-ignore), alerts, documents, log records and an agg_batch
    record.

    Statistics are over the rows of this micro-batch, as in the reference.
    The batch is persisted once and every output reads it; its moments come
    back as one row of three numbers, and the number of anomalies is observed
    while the summary is written. Only emitted anomalies meet the dimension,
    whose current snapshot is asked for once a trigger."""

    def __init__(self, spec: WindowSpec, users: Dimension, outputs: Outputs, settings: Settings):
        self.spec, self.users, self.outputs, self.settings = spec, users, outputs, settings

    def _new_only(self, enriched: DataFrame, batch_id: int) -> DataFrame:
        """Anomalies whose key no earlier batch inserted. Only log rows from the
        batch's earliest window on can match, so the read is bounded by it
        (Parquet skips older row groups)."""
        first = enriched.agg(F.min("window_start")).first()[0]
        earlier = self.outputs.anomalies.log().filter(
            (F.col("source") == self.spec.name)
            & (version() < version(F.lit(self.outputs.run), F.lit(int(batch_id))))
            & (F.col("window_start") >= F.lit(first)))
        return enriched.join(earlier.select(*SUMMARY_KEY), list(SUMMARY_KEY), "left_anti")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        s, tag, outputs = self.settings, self.spec.name, self.outputs
        outputs.check_run()
        summary = flatten_window(batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stats = AN.moments(summary).first()  # one row: n, sum, sum of squares
            if not stats["n"]:
                return
            graded = AN.grade(AN.with_zscore(summary, stats=stats), s.anomaly_threshold, s.z_threshold)
            anomalies = AN.emitted(graded).drop("is_anomaly")
            enriched = enrich_users(anomalies, self.users.current()).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                documents = A.anomaly_documents(enriched)

                def write_summary() -> None:
                    written = Observation(f"{tag}_{batch_id}")
                    rows = graded.observe(written, emitted_count().alias("anomalies")).select(*summary.columns)
                    outputs.write_keyed(outputs.summary, rows, batch_id, tag)
                    sums = summary.sparkSession.createDataFrame(
                        [(stats["n"], stats["s1"], stats["q"], written.get["anomalies"])],
                        f"n long, s1 {AN.EXACT}, q {AN.EXACT}, anomalies long")
                    record = as_log_records(agg_record_of(sums, batch_id, tag, s.z_threshold))
                    outputs.write_log(record.unionByName(as_log_records(documents)), tag, batch_id)

                writes = [write_summary]
                # an empty dynamic-overwrite write changes nothing, so most
                # triggers (no anomaly) skip the three writes after one check
                if not enriched.isEmpty():
                    to_alert = self._new_only(enriched, batch_id) if s.alert_new_only else enriched
                    writes += [
                        lambda: outputs.write_keyed(outputs.anomalies, enriched.select(*SUMMARY_KEY, "event_count"),
                                                    batch_id, tag),
                        lambda: outputs.write_alerts(A.alert_messages(A.alert_records(to_alert)), tag, batch_id),
                        lambda: outputs.write_documents(documents, tag, batch_id),
                    ]
                run_all(*writes)
            finally:
                enriched.unpersist()
        finally:
            summary.unpersist()
