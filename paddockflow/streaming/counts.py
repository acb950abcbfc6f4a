"""What streams lose and hold: rows in, refused and late per batch, and windows still open."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

OBSERVED = "paddockflow_rows"

BATCH_COUNTS = (
    "query STRING, query_id STRING, batch_id BIGINT, rows_in BIGINT, rows_refused BIGINT, late_groups BIGINT, "
    "open_groups BIGINT"
)


def observed(rows: DataFrame, refused: Column) -> DataFrame:
    """Count rows, and those for which ``refused`` holds, while they pass."""
    return rows.observe(
        OBSERVED, F.count(F.lit(1)).alias("rows_in"), F.count_if(refused).alias("rows_refused")
    )


class BatchCounts(StreamingQueryListener):
    """Writes one row a batch: what came in, what was refused, what came too late, what is held.

    ``late_groups`` and ``open_groups`` are rows of the state: groups of a batch behind the
    watermark, and groups that wait for it.  Rows go to ``path``, a folder all can reach, as each
    batch ends; a query without :func:`observed` rows has NULL for its rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, set()

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        operators = progress.stateOperators
        row = (
            progress.name, str(progress.id), progress.batchId,
            seen["rows_in"] if seen else None, seen["rows_refused"] if seen else None,
            sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in operators),
        )
        self.spark.createDataFrame([row], BATCH_COUNTS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until all batches of a run that has ended are written; events arrive in order."""
        until = time.time() + seconds
        while run_id not in self.ended:
            if time.time() > until:
                raise TimeoutError(f"no end of run {run_id} within {seconds} s")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        return self.spark.read.schema(BATCH_COUNTS).parquet(self.path)


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0) -> DataFrame:
    """Groups that a windowed aggregation still holds, out of its checkpoint.

    ``window_start``, ``window_end``, the other group columns, and the aggregation's buffers in
    order as ``buffer_0``, ``buffer_1`` and so on.  Reads the state after ``batch``, the last
    one unless given; the query need not run.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    window = next(f.name for f in state.schema["key"].dataType if "window" in f.name.lower())
    keys = [f.name for f in state.schema["key"].dataType if f.name != window]
    # buffers of one function share a name, so they are told apart by place
    buffers = [(f"buffer_{n}", f.dataType.simpleString()) for n, f in enumerate(state.schema["value"].dataType)]
    numbered = F.col("value").cast(f"struct<{','.join(f'{name}:{kind}' for name, kind in buffers)}>").alias("value")
    return state.select("key", numbered).select(
        F.col("key").getField(window)["start"].alias("window_start"),
        F.col("key").getField(window)["end"].alias("window_end"),
        *[F.col("key").getField(k).alias(k) for k in keys],
        "value.*",
    )
