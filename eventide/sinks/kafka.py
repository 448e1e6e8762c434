"""Kafka topic writes (needs the Kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Settings


def sink_options(settings: Settings, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.kafka_brokers,
        "topic": topic,
        "kafka.compression.type": "snappy",
    }


def write_topic(messages: DataFrame, settings: Settings, topic: str) -> None:
    """(key?, value) rows -> one message each; executors send in parallel."""
    messages.write.format("kafka").options(**sink_options(settings, topic)).save()
