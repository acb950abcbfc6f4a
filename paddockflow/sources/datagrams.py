"""Captured datagrams, one per row or one per file, as a ``payload`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str, fmt: str = "parquet", payload: str = "payload") -> DataFrame:
    """A capture table with a binary column, or with ``binaryFile`` one file each."""
    if fmt == "binaryFile":
        files = spark.read.format(fmt).load(path)
        return files.select(
            F.col("path").alias("source"),
            F.col("modificationTime").alias("timestamp"),
            F.col("content").alias("payload"),
        )
    return spark.read.format(fmt).load(path).withColumnRenamed(payload, "payload")


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
