"""Warehouse tables, partitioned by ``session_uid``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddockflow.schemas import WAREHOUSE, names

PARTITION = "session_uid"
BATCH = "batch"  # names the micro-batch that wrote the rows, see streaming.sinks


def location(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def create_tables(
    spark: SparkSession, root: str, database: str | None = None, provider: str = "parquet"
) -> list[str]:
    """Declare the five tables over ``root``; declaring them again changes nothing.

    With an ``iceberg`` catalog set up on the session, ``provider="iceberg"`` declares such tables;
    nothing here writes them, since the sinks append parquet files under ``root``.
    """
    declared = []
    for table, ddl in WAREHOUSE.items():
        name = f"{database}.{table}" if database else table
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, {BATCH} STRING) USING {provider} "
            f"PARTITIONED BY ({PARTITION}, {BATCH}) LOCATION '{location(root, table)}'"
        )
        declared.append(name)
    return declared


def refresh_tables(spark: SparkSession, tables: list[str]) -> None:
    """Let declared tables, already written to, see partitions sinks added by path."""
    for name in tables:
        spark.catalog.recoverPartitions(name)


def read(spark: SparkSession, root: str, table: str, session_uid: int | None = None) -> DataFrame:
    """One table's rows; with a session id only that session's folder is listed and read."""
    stored = f"{WAREHOUSE[table]}, {BATCH} STRING"
    path = location(root, table)
    reader = spark.read.schema(stored)
    if session_uid is None:
        return reader.parquet(path).select(*names(table))
    one = f"{path}/{PARTITION}={int(session_uid)}"
    if not exists(spark, one):
        return reader.parquet(path).where(F.lit(False)).select(*names(table))
    return reader.option("basePath", path).parquet(one).select(*names(table))


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def compact(spark: SparkSession, root: str, table: str, session_uid: int, into: str) -> None:
    """Rewrite one session's closed batches as one batch of the table under another root.

    For sessions that get no more rows; ``into`` must be another root, so that readers of the
    old files are not disturbed and a failed run leaves them whole.
    """
    if location(root, table) == location(into, table):
        raise ValueError("compaction needs another root")
    rows = read(spark, root, table, session_uid).withColumn(BATCH, F.lit("compacted"))
    (
        rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION, BATCH).parquet(location(into, table))
    )
