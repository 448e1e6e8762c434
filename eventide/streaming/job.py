"""The streaming job: four queries over one event source.

raw      classified text, keys tagged by state -> foreachBatch(RawEventsHandler), append
archive  parsed events -> Parquet file sink (exactly-once via its log)
5s, 1min watermarked window counts -> foreachBatch(WindowBatchHandler), update

Each query has its own checkpoint folder and reads the source on its own.
The aggregate path is not repartitioned by user first: a hot user would land
in one partition, and the stateful aggregate shuffles on (window, user) anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..functions.parse import classify, good_rows
from ..operators.windows import counts_for
from ..sinks.outputs import Outputs
from ..sinks.runs import claim_run
from ..sources.dimension import Dimension
from .handlers import RawEventsHandler, WindowBatchHandler, tagged_raw_rows


def _trigger(writer, settings: Settings, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=settings.trigger)


def start_queries(spark: SparkSession, source: DataFrame, users: Dimension, outputs: Outputs,
                  settings: Settings, checkpoint_root: str, available_now: bool = False,
                  name_prefix: str = "") -> list[StreamingQuery]:
    """Start the four queries on a ``value`` stream and return them. Their
    outputs carry the checkpoint's run number."""
    ckpt = checkpoint_root.rstrip("/")
    outputs.run = claim_run(spark, outputs.root, ckpt)
    classified = classify(source)
    parsed = good_rows(classified)
    started = []

    raw = (tagged_raw_rows(classified, settings).writeStream.outputMode("append")
           .foreachBatch(RawEventsHandler(outputs, settings))
           .option("checkpointLocation", f"{ckpt}/user_events"))
    started.append(_trigger(raw, settings, available_now).queryName(f"{name_prefix}raw").start())

    archive = (parsed.writeStream.format("parquet").outputMode("append")
               .option("path", outputs.archive_path)
               .option("checkpointLocation", f"{ckpt}/parquet"))
    started.append(_trigger(archive, settings, available_now).queryName(f"{name_prefix}archive").start())

    for spec in settings.windows:
        counts = counts_for(parsed, spec, streaming=True)
        agg = (counts.writeStream.outputMode("update")
               .foreachBatch(WindowBatchHandler(spec, users, outputs, settings))
               .option("checkpointLocation", f"{ckpt}/user_activity_summary_{spec.name}"))
        started.append(_trigger(agg, settings, available_now).queryName(f"{name_prefix}agg_{spec.name}").start())
    return started


def run_until_done(queries: list[StreamingQuery]) -> None:
    """Wait for availableNow queries; re-raise the first failure."""
    for q in queries:
        q.awaitTermination()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name} failed: {q.exception()}")


def await_any(spark: SparkSession) -> None:
    """Block until any query ends (the job ends with it)."""
    spark.streams.awaitAnyTermination()
