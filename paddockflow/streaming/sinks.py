"""Micro-batch sinks that can be replayed.

A batch is written under a ``batch`` partition named after the query and the batch
number, and overwrites only the partitions it writes.  A batch that runs again after
a failure therefore replaces its own rows instead of adding them twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from paddockflow.sources.warehouse import BATCH, PARTITION, location


def batch_name(rows: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch, unique over restarts and over fresh checkpoints.

    The query id lives in the checkpoint: it survives a restart, and a query started
    on a new checkpoint, whose numbers begin at zero again, gets another one.  Outside a
    streaming query there is no such name.
    """
    query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("batches are named after a streaming query, and none runs here")
    return f"{query}-{batch_id:012d}"


def append_table(rows: DataFrame, root: str, table: str, batch: str) -> None:
    """Append a batch to a warehouse table, split by session.

    The rebalance gathers each session's rows, so that it gets one file per batch, and
    adaptive execution splits a session that is large.  Small shuffle partitions stay
    apart: what a task has to write here is folders, however few their bytes.
    """
    with adaptive(rows.sparkSession, merge_small=False):
        placed = rows.withColumn(BATCH, F.lit(batch)).hint("rebalance", F.col(PARTITION))
        _replace_partitions(placed, PARTITION, BATCH).parquet(location(root, table))


def append_lineage(rows: DataFrame, root: str, table: str, batch: str) -> None:
    """Append span or link rows, split by batch only."""
    with adaptive(rows.sparkSession):
        placed = rows.withColumn(BATCH, F.lit(batch)).hint("rebalance")
        _replace_partitions(placed, BATCH).parquet(location(root, table))


def _replace_partitions(rows: DataFrame, *columns: str) -> DataFrameWriter:
    return (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
    )


@contextmanager
def adaptive(session: SparkSession, merge_small: bool = True) -> Iterator[None]:
    """Adaptive execution for a write of a micro-batch.

    Spark turns it off in a stream's session, because it must not touch stateful
    plans.  The micro-batch itself is planned by the time its writes begin.  Rebalance
    hints only hold where they are given inside.
    """
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": str(merge_small).lower(),
    }
    before = {setting: session.conf.get(setting) for setting in wanted}
    for setting, value in wanted.items():
        session.conf.set(setting, value)
    try:
        yield
    finally:
        for setting, value in before.items():
            session.conf.set(setting, value)


@dataclass(frozen=True)
class FeedSink:
    """Where keyed records go: a Kafka topic, or files with the same columns.

    Kafka takes ``kafka.bootstrap.servers`` and ``topic`` and is written at least
    once; files take ``path`` and are replaced on replay.  Parquet files are packed with zstd
    unless ``options`` names a ``compression``: records repeat their field names.
    """

    fmt: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)

    def write(self, records: DataFrame, batch: str, gather: bool = True) -> None:
        """Write a batch; without ``gather`` each task writes its own file and no record is shuffled."""
        if self.fmt == "kafka":
            records.write.format("kafka").options(**self.options).save()
            return
        with adaptive(records.sparkSession):
            placed = records.withColumn(BATCH, F.lit(batch))
            packed = {"compression": "zstd"} if self.fmt == "parquet" else {}
            _replace_partitions(placed.hint("rebalance") if gather else placed, BATCH).format(self.fmt).options(
                **{**packed, **self.options}
            ).save()


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep rows for several writes, on disk where memory does not do."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def kept(action: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that computes the batch once for all its writes.

    Counting fills the cache in one job over all partitions, which a stateful query
    needs to commit its state, and lets a batch that closed no window skip the writes.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        with held(rows):
            if rows.count():
                action(rows, batch_name(rows, batch_id))

    return run


def single(action: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for an action with one write, which needs nothing kept."""

    def run(rows: DataFrame, batch_id: int) -> None:
        action(rows, batch_name(rows, batch_id))

    return run
