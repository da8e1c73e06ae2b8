"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Start at the oldest message, and wait this long for the brokers.
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "kafka.request.timeout.ms": "60000",
    "kafka.session.timeout.ms": "60000",
}
# Go on when messages are gone, and take at most this many per micro-batch.
REFERENCE_RATE = {"failOnDataLoss": "false", "maxOffsetsPerTrigger": "10000"}


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    tolerate_loss: bool = False,
    rows_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """The messages of a topic; needs Spark's Kafka connector on the class path.

    A gap in the topic ends the stream unless ``tolerate_loss``; Spark then logs each gap.
    ``rows_per_batch`` bounds a micro-batch, whatever the number of executors, so it grows with
    the cluster or stays off. ``**REFERENCE_RATE`` gives the small fixed setting of both.
    """
    settings = {**KAFKA_DEFAULTS, "failOnDataLoss": str(not tolerate_loss).lower()}
    if rows_per_batch:
        settings["maxOffsetsPerTrigger"] = str(rows_per_batch)
    settings |= {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    return spark.readStream.format("kafka").options(**settings).load()


def file_messages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Message bodies from Parquet files with a ``value`` column that land in a folder."""
    return (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", str(files_per_trigger))
        .parquet(path)
    )
