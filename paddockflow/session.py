"""Session settings the jobs are written for.

``build`` is for stand-alone use; a session handed in by a cluster is only given
the settings that decide results (UTC), never its sizing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizing and adaptive settings for a large cluster.  AQE merges small shuffle
# partitions, so a high initial count costs little on small inputs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Windows, ISO text and NTZ casts are all defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build(app_name: str = "paddockflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())
