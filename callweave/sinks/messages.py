"""Messages to a broker or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Wait for all replicas, five retries, gzip.
KAFKA_PRODUCER_DEFAULTS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "500",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
    "kafka.buffer.memory": "33554432",
    "kafka.compression.type": "gzip",
}


def send_kafka(messages: DataFrame, servers: str, **options: str) -> None:
    """Send ``topic``, ``value`` and optional ``key``; needs Spark's Kafka connector."""
    settings = {**KAFKA_PRODUCER_DEFAULTS, "kafka.bootstrap.servers": servers, **options}
    messages.write.format("kafka").options(**settings).save()


def land_messages(messages: DataFrame, path: str) -> None:
    """Append messages to a folder that ``file_messages`` can stream from."""
    messages.write.mode("append").parquet(path)
