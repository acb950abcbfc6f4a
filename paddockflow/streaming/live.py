"""State that a live view needs, kept by key: latest rows, short histories, windows that end.

Each processor holds a bounded state per key and gives out changes only.  Rows are cut down
ahead of the shuffle, per Arrow batch, to what can still matter for a key, so a key with a third
of all rows sends little to the one task that keeps its state.  State lives in RocksDB, which
these processors need.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from paddockflow.operators import serve, windows

KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

ENTERED, LEFT, LATEST = "entered", "left", "latest"
ON_TIME, IDLE, LATE = "watermark", "idle", "late"


def _age(order: Sequence[int]):
    """Sort key of a row tuple: rows without a value are the oldest."""
    return lambda row: tuple((row[i] is not None, row[i]) if row[i] is not None else (False,) for i in order)


def newest_of_batches(rows: DataFrame, kind: str, order: Sequence[str], n: int) -> DataFrame:
    """The newest ``n`` rows of each kind out of every Arrow batch; others can't be among the last ``n``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            newest = pc.sort_indices(
                batch, sort_keys=[(c, "descending") for c in order], null_placement="at_end"
            ).to_numpy()
            codes = batch.column(kind).dictionary_encode(null_encoding="encode").indices.to_numpy()[newest]
            by_kind = np.argsort(codes, kind="stable")
            starts = np.searchsorted(codes[by_kind], codes[by_kind])
            kept = by_kind[np.arange(len(codes)) - starts < n]
            yield batch.take(pa.array(newest[kept]))

    return rows.mapInArrow(run, rows.schema)


class LiveHistory(StatefulProcessor):
    """The latest row (value state) and the last ``n`` rows (list state) of a kind."""

    def __init__(self, schema: T.StructType, order: Sequence[str], n: int):
        self.schema, self.n = schema, n
        self.order = [schema.names.index(c) for c in order]

    def init(self, handle):
        self.latest = handle.getValueState("latest", self.schema)
        self.history = handle.getListState("history", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        age, names = _age(self.order), self.schema.names
        before = [tuple(r) for r in self.history.get()] if self.history.exists() else []
        arrived = (tuple(r[c] for c in names) for r in rows)
        after = heapq.nlargest(self.n, (*before, *heapq.nlargest(self.n, arrived, age)), age)
        had, has = Counter(before), Counter(after)
        if had == has:
            return
        self.history.put(after)
        for change, those in ((LEFT, had - has), (ENTERED, has - had)):
            for row in those.elements():
                yield Row(change=change, **dict(zip(names, row)))
        if not self.latest.exists() or tuple(self.latest.get()) != after[0]:
            self.latest.update(after[0])
            yield Row(change=LATEST, **dict(zip(names, after[0])))

    def close(self):
        pass


def live_changes(rows: DataFrame, kind: str, order: Sequence[str], n: int = serve.HISTORY_ROWS) -> DataFrame:
    """Changes of every kind's latest row and last ``n`` rows, as a stream.

    ``change`` is ``entered`` or ``left`` for the history and ``latest`` for a new latest row; a
    batch gives at most ``2 n + 1`` rows a kind, however many came in.  NULL is a kind too.  Rows
    alike in all columns count one by one.
    """
    times = {f.name: f.dataType for f in rows.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    # times as numbers: rows and state give Python different kinds of time
    stored = rows.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in times})
    schema = T.StructType([T.StructField("change", T.StringType()), *stored.schema.fields])
    changes = (
        newest_of_batches(stored, kind, order, n)
        .groupBy(kind)
        .transformWithState(LiveHistory(stored.schema, order, n), schema, "Append", "None")
    )
    return changes.withColumns({c: F.timestamp_micros(c).cast(kind_of) for c, kind_of in times.items()})


def history_of(changes: DataFrame) -> DataFrame:
    """The history that a table of changes amounts to."""
    columns = [c for c in changes.columns if c != "change"]
    entered = F.count_if(F.col("change") == ENTERED) - F.count_if(F.col("change") == LEFT)
    held = changes.where(F.col("change") != LATEST).groupBy(*columns).agg(entered.alias("_copies"))
    return held.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("_copies", F.lit(1))))).where(
        "_copies > 0"
    ).select(*columns)


def latest_of(changes: DataFrame, kind: str, order: str, tie: str) -> DataFrame:
    """The latest rows that a table of changes amounts to."""
    return serve.latest_per_kind(changes.where(F.col("change") == LATEST).drop("change"), kind, order, tie)


# --- windows that also end when their feed stalls -----------------------------------------


def _partial_schema(measures: Sequence[str]) -> str:
    stats = ", ".join(f"sum_{m} long, count_{m} long, min_{m} int, max_{m} int" for m in measures)
    return f"session_uid long, start long, newest long, session_time double, sample_count long, {stats}"


def batch_partials(rows: DataFrame, measures: Sequence[str], seconds: int) -> DataFrame:
    """Telemetry rows as partial aggregates per session, window and Arrow batch; times in microseconds."""
    width = seconds * 1_000_000
    at = F.unix_micros("timestamp")
    narrow = rows.where(F.col("timestamp").isNotNull()).select(
        "session_uid", (at - F.pmod(at, F.lit(width))).alias("start"),
        at.alias("newest"), F.col("session_time").cast("double").alias("session_time"),
        *[F.col(m).cast("int").alias(m) for m in measures],
    )

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        asked = [("newest", "max"), ("session_time", "max"), ("start", "count", pc.CountOptions(mode="all"))]
        asked += [(m, f) for m in measures for f in ("sum", "count", "min", "max")]
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["session_uid", "start"]).aggregate(asked)
            yield from found.select(order).rename_columns(names).combine_chunks().to_batches()

    schema = _partial_schema(measures)
    names = [part.split()[0] for part in schema.split(", ")]
    order = ["session_uid", "start", "newest_max", "session_time_max", "start_count"]
    order += [f"{m}_{f}" for m in measures for f in ("sum", "count", "min", "max")]
    return narrow.mapInArrow(run, schema)


def _joined(old: tuple | None, new: tuple) -> tuple:
    """Two partials in the order of ``_partial_schema`` from ``session_time`` on."""
    if old is None:
        return new
    most = lambda f, a, b: a if b is None else b if a is None else f(a, b)
    total = lambda a, b: a + b
    rules = [max, total] + [total, total, min, max] * ((len(new) - 2) // 4)
    return tuple(most(f, a, b) for f, a, b in zip(rules, old, new))


class ClosingWindows(StatefulProcessor):
    """Open windows of a session, closed by its own event time or, when it stalls, by a timer.

    A window is given out once.  Rows for a window that is out already come out as ``late``, so
    that they can be counted.
    """

    def __init__(self, measures: Sequence[str], width_us: int, delay_us: int, idle_ms: int):
        self.measures, self.width, self.delay, self.idle = list(measures), width_us, delay_us, idle_ms

    def init(self, handle):
        self.handle = handle
        self.names = [part.split()[0] for part in _partial_schema(self.measures).split(", ")][3:]
        stored = ", ".join(_partial_schema(self.measures).split(", ")[3:])
        self.open = handle.getMapState("open", "start long", stored)
        self.clock = handle.getValueState("clock", "newest long, closed long")

    def _out(self, key, start, values, closed_by):
        return Row(session_uid=key[0], start=start, closed_by=closed_by, **dict(zip(self.names, values)))

    def handleInputRows(self, key, rows, timerValues):
        newest, closed = tuple(self.clock.get()) if self.clock.exists() else (None, None)
        held = {start: tuple(values) for (start,), values in self.open.iterator()}
        touched = set()
        for r in rows:
            values = tuple(r[c] for c in self.names)
            if closed is not None and r["start"] + self.width <= closed:
                yield self._out(key, r["start"], values, LATE)
                continue
            held[r["start"]] = _joined(held.get(r["start"]), values)
            touched.add(r["start"])
            newest = r["newest"] if newest is None else max(newest, r["newest"])
        if newest is None:
            return
        closed = newest - self.delay if closed is None else max(closed, newest - self.delay)
        for start in sorted(held):
            if start + self.width <= closed:
                yield self._out(key, start, held[start], ON_TIME)
                if self.open.containsKey((start,)):
                    self.open.removeKey((start,))
            elif start in touched:
                self.open.updateValue((start,), held[start])
        self.clock.update((newest, closed))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        newest, closed = tuple(self.clock.get())
        held = sorted((start, tuple(values)) for (start,), values in self.open.iterator())
        for start, values in held:
            yield self._out(key, start, values, IDLE)
            self.open.removeKey((start,))
            closed = max(closed, start + self.width)
        self.clock.update((newest, closed))

    def close(self):
        pass


def closing_windows(
    rows: DataFrame,
    measures: Sequence[str] = windows.MEASURES,
    seconds: int = 1,
    delay_seconds: float = 1,
    idle_seconds: float = 30,
) -> DataFrame:
    """Window aggregates of a telemetry stream that also end when a session stops sending.

    Unlike a watermark, which waits for new rows of any session, each session has its own event
    time, and a session without rows for ``idle_seconds`` has its open windows closed.  Columns
    are those of ``windows.telemetry_windows`` and ``closed_by``: ``watermark``, ``idle`` or
    ``late``; late rows are partial aggregates of a window that is out.  Rows without a time have
    no window.
    """
    keyed = batch_partials(rows, measures, seconds).groupBy("session_uid")
    kept = [part for part in _partial_schema(measures).split(", ") if not part.startswith("newest ")]
    out = "closed_by string, " + ", ".join(kept)
    processor = ClosingWindows(measures, seconds * 1_000_000, int(delay_seconds * 1e6), int(idle_seconds * 1000))
    closed = keyed.transformWithState(processor, out, "Append", "ProcessingTime")
    stats = []
    for m in measures:
        stats += [
            F.when(F.col(f"count_{m}") > 0, F.col(f"sum_{m}").cast("double") / F.col(f"count_{m}")).alias(f"avg_{m}"),
            f"min_{m}", f"max_{m}",
        ]
    return closed.select(
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + seconds * 1_000_000).alias("window_end"),
        "session_uid", F.col("session_time").cast("float").alias("session_time"), *stats, "sample_count", "closed_by",
    )
