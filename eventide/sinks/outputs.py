"""Where the job writes: one object naming every output of the job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..schemas import LOG_SCHEMA, RAW_NATURAL_KEY, RAW_STORE_SCHEMA, SUMMARY_KEY, SUMMARY_SCHEMA
from .batches import write_batch
from .keyed import KeyedTable, merge_into
from .runs import fence


@dataclass
class Outputs:
    spark: SparkSession
    root: str
    settings: Settings
    alert_format: str = "json"  # or "kafka"
    raw_format: str = "parquet"  # or "jdbc"
    keyed_format: str = "parquet"  # or "jdbc", or "table" (a catalog with row changes)
    run: int = 0

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def check_run(self) -> None:
        """Raise if a newer run writes here."""
        fence(self.spark, self.root, self.run)

    @property
    def summary(self) -> KeyedTable:
        return KeyedTable(self.spark, self.path("user_activity_summary"), SUMMARY_KEY, keep="last",
                          schema=SUMMARY_SCHEMA, run=self.run)

    @property
    def anomalies(self) -> KeyedTable:
        return KeyedTable(self.spark, self.path("anomalous_events"), SUMMARY_KEY, keep="first",
                          schema=SUMMARY_SCHEMA, run=self.run)

    @property
    def archive_path(self) -> str:
        return self.path("archive")

    def write_keyed(self, table: KeyedTable, rows: DataFrame, batch_id: int, tag: str) -> None:
        """Upsert or insert-ignore of a micro-batch, on files, over JDBC or into a catalog table."""
        name = table.path.rsplit("/", 1)[-1]
        if self.keyed_format == "jdbc":
            from .jdbc import commit_batch
            commit_batch(rows, self.settings, name, table.keys, f"{name}_{tag}", self.run, batch_id, table.keep)
        elif self.keyed_format == "table":
            merge_into(rows, name, table.keys, table.keep)
        else:
            table.write(rows, batch_id, tag)

    def write_raw(self, rows: DataFrame, batch_id: int) -> None:
        """Stored events; on files partitioned by (event_date, run, batch_id),
        so a replay overwrites only what its first attempt wrote and readers
        prune by date; over JDBC staged and merged on the natural key, once per
        batch."""
        if self.raw_format == "jdbc":
            from .jdbc import commit_batch
            commit_batch(rows, self.settings, "user_events", list(RAW_NATURAL_KEY), "user_events", self.run, batch_id,
                         keep="first")
            return
        out = (rows.withColumn("event_date", F.to_date(F.col("timestamp")))
               .withColumn("run", F.lit(int(self.run)).cast("long"))
               .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "run", "batch_id").parquet(self.path("user_events")))

    def stored_raw(self) -> DataFrame:
        """Stored events with event_date, run and batch_id; empty before the first."""
        from pyspark.errors import AnalysisException
        try:
            return self.spark.read.schema(RAW_STORE_SCHEMA).parquet(self.path("user_events"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RAW_STORE_SCHEMA)

    def log_records(self) -> DataFrame:
        """Audit and anomaly records (type, batch_id, logged_at, payload) with their source and run."""
        from pyspark.errors import AnalysisException
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(self.path("logs"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def write_alerts(self, messages: DataFrame, tag: str, batch_id: int) -> None:
        """(key, value) alert messages: always one JSON line each in the alert
        log folder, and to the alert topic when Kafka is configured."""
        write_batch(messages.select("value"), self.path("alerts"), tag, batch_id, fmt="text", run=self.run)
        if self.alert_format == "kafka":
            from .kafka import write_topic
            write_topic(messages, self.settings, self.settings.alerts_topic)

    def write_documents(self, docs: DataFrame, tag: str, batch_id: int) -> None:
        write_batch(docs, self.path("documents"), tag, batch_id, fmt="json", run=self.run)

    def write_dead_letters(self, rejects: DataFrame, tag: str, batch_id: int) -> None:
        if self.alert_format == "kafka":
            from ..functions.alerts import to_json_value
            from .kafka import write_topic
            write_topic(rejects.select(to_json_value(rejects).alias("value")),
                        self.settings, self.settings.dead_letter_topic)
        else:
            write_batch(rejects, self.path("dead_letters"), tag, batch_id, fmt="json", run=self.run)

    def write_log(self, records: DataFrame, tag: str, batch_id: int) -> None:
        write_batch(records, self.path("logs"), tag, batch_id, fmt="json", run=self.run)
