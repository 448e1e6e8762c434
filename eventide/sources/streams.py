"""Event and alert streams with one contract: a ``value`` column of JSON text.

Kafka is the production source; a directory of JSON-lines files is the
drop-in used by tests and replays. Both give the parser the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings


#: Fixed values that must equal the reference's: where a topic is read from and what happens to offsets lost to retention.
KAFKA_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_source_options(settings: Settings, topic: str, max_offsets: int | None = None,
                         min_offsets: int | None = None, max_delay: str | None = None) -> dict[str, str]:
    """Options of a Kafka subscription. ``max_offsets`` caps a micro-batch; with
    ``min_offsets`` a micro-batch waits for so many records, but no longer than
    ``max_delay``."""
    opts = {"kafka.bootstrap.servers": settings.kafka_brokers, "subscribe": topic, **KAFKA_OPTIONS}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_offsets:
        opts["minOffsetsPerTrigger"] = str(min_offsets)
        opts["maxTriggerDelay"] = max_delay or "1s"
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka topic as a stream of ``value`` text (needs the Kafka connector)."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value")


def event_options(settings: Settings) -> dict[str, str]:
    return kafka_source_options(settings, settings.events_topic, settings.max_offsets_per_trigger)


def alert_options(settings: Settings) -> dict[str, str]:
    """The notifier acts once enough alerts are there or the delay is over,
    and then takes all of them unless a cap is set."""
    return kafka_source_options(settings, settings.alerts_topic, settings.alerts_per_trigger,
                                settings.least_alerts, settings.alert_delay)


def event_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    return kafka_stream(spark, event_options(settings))


def alert_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    return kafka_stream(spark, alert_options(settings))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Directory of JSON lines as a stream of ``value`` text; files are taken
    oldest first, ``max_files_per_trigger`` bounds each micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
