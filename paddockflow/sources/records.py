"""Keyed record feeds: Kafka topics, or files holding the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddockflow.schemas import RECORD


def kafka_options(servers: str, topic: str, starting: str = "latest", **more: str) -> dict[str, str]:
    """Reader options of one topic, with record headers."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "includeHeaders": "true",
        "startingOffsets": starting,
        **more,
    }


def stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """A live record feed.  File formats need ``path`` and use the record schema.

    ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` bound a micro-batch, and
    ``minPartitions`` lets Kafka reads go wider than the topic.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load() if fmt == "kafka" else reader.schema(RECORD).load()


def table(spark: SparkSession, fmt: str = "parquet", **options: str) -> DataFrame:
    """The same feed read once, as a batch."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load() if fmt == "kafka" else reader.schema(RECORD).load()
