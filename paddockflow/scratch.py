"""Shared scratch folders for checkpoints and written intermediates."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


@functools.cache
def _single_machine_root() -> str:
    return tempfile.mkdtemp(prefix="paddockflow-")


def root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a session whose driver is its one executor may do without the setting; it gets
    one temporary folder for the life of the process, and its settings stay untouched.
    """
    found = spark.conf.get(_SETTING, None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    return _single_machine_root()


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The rows written to a fresh shared folder and read back: cuts lineage, survives executors."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder wherever it is stored."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def remove_saved(frame: DataFrame) -> None:
    """Delete what ``saved`` wrote, once nothing reads it any more."""
    for path in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        remove(frame.sparkSession, path)
