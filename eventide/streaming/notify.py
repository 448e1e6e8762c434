"""Alert stream -> checked alerts, payload log, rendered notifications.

One query reads the alert topic. It acts once ``Settings.least_alerts`` are there
or ``Settings.alert_delay`` is over, on all there are unless
``Settings.alerts_per_trigger`` is set, and each micro-batch writes three
outputs: every payload as a JSON line, the messages of valid high/medium alerts,
and the invalid alerts with the key they lack."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.alerts import decode_alerts, notifications
from ..sinks.batches import write_batch
from ..sinks.runs import claim_run, fence


class NotifyHandler:
    def __init__(self, root: str, run: int = 0):
        self.root, self.run = root.rstrip("/"), run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        fence(batch_df.sparkSession, self.root, self.run)
        if batch_df.isEmpty():
            return
        checked = decode_alerts(batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(checked.select("value"), f"{self.root}/payloads", "alerts", batch_id, fmt="text", run=self.run)
            write_batch(notifications(checked), f"{self.root}/messages", "alerts", batch_id, fmt="json", run=self.run)
            invalid = checked.filter(F.col("check") != "valid").select("check", "value")
            write_batch(invalid, f"{self.root}/invalid", "alerts", batch_id, fmt="json", run=self.run)
        finally:
            checked.unpersist()


def start_notifier(alert_stream: DataFrame, root: str, checkpoint: str, trigger: str = "1 second",
                   available_now: bool = False) -> StreamingQuery:
    run = claim_run(alert_stream.sparkSession, root, checkpoint)
    writer = (alert_stream.writeStream.foreachBatch(NotifyHandler(root, run))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.queryName("notify").start()
