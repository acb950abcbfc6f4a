"""Tumbling-window aggregates.

All aggregates here are algebraic over fixed-width columns: Spark combines them
before the shuffle, in a hash aggregate inside generated code, so a session holding
a third of all rows still ships one row per window and task.  Which packets fed a
window is kept in link rows (see ``lineage``), never as an array in the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow.functions import traces

# Window widths and watermark delay.
TELEMETRY_WINDOW = "1 second"
LAP_WINDOW = "5 seconds"
WATERMARK_DELAY = "1 second"

MEASURES = ("speed", "rpm")
LAP_MEASURES = (
    "current_lap_num", "last_lap_time_ms", "current_lap_time_ms", "sector1_time_ms",
    "sector2_time_ms", "car_position", "speed_trap_fastest_speed", "num_pit_stops",
    "penalties", "total_warnings", "corner_cutting_warnings", "grid_position",
)


def watermarked(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Bound lateness on a stream; a batch has no late rows."""
    return rows.withWatermark("timestamp", delay) if rows.isStreaming else rows


def window_aggregate(
    rows: DataFrame,
    width: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Aggregate per ``[start, end)`` window, aligned to the epoch, and keys."""
    grouped = watermarked(rows, delay).groupBy(F.window("timestamp", width).alias("window"), *keys)
    out = grouped.agg(*aggregates)
    return out.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in out.columns if c != "window"],
    )


def _measure(name: str) -> list[Column]:
    return [
        F.avg(name).alias(f"avg_{name}"),
        F.min(name).alias(f"min_{name}"),
        F.max(name).alias(f"max_{name}"),
    ]


def telemetry_windows(
    rows: DataFrame,
    measures: Sequence[str] = MEASURES,
    width: str = TELEMETRY_WINDOW,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """avg, min and max per session of each measure, in one aggregation.

    ``sample_count`` counts all packets, also those whose measure is NULL.
    """
    aggregates = [
        F.max("session_time").alias("session_time"),
        *[column for name in measures for column in _measure(name)],
        F.count("*").alias("sample_count"),
    ]
    return window_aggregate(rows, width, ["session_uid"], aggregates, delay)


def open_telemetry_windows(held: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """As :func:`telemetry_windows`, from the buffers of windows that its stream still holds.

    ``held`` is ``counts.open_windows`` of that stream: one buffer for the session time, four for
    each measure (sum, count, min, max), one for the count.
    """
    stats, n = [], 1
    for name in measures:
        total, known, low, high = (F.col(f"buffer_{n + k}") for k in range(4))
        stats += [
            F.when(known > 0, total / known).alias(f"avg_{name}"), low.alias(f"min_{name}"), high.alias(f"max_{name}")
        ]
        n += 4
    return held.select(
        "window_start", "window_end", "session_uid", F.col("buffer_0").alias("session_time"), *stats,
        F.col(f"buffer_{n}").alias("sample_count"),
    )


def measure_columns(measure: str) -> list[str]:
    """Columns of one measure's aggregate table, in table order."""
    return [
        "window_start", "window_end", "session_uid", "session_time",
        f"avg_{measure}", f"min_{measure}", f"max_{measure}", "sample_count",
    ]


def speed_windows(rows: DataFrame, width: str = TELEMETRY_WINDOW, delay: str = WATERMARK_DELAY) -> DataFrame:
    return telemetry_windows(rows, ["speed"], width, delay).select(measure_columns("speed"))


def rpm_windows(rows: DataFrame, width: str = TELEMETRY_WINDOW, delay: str = WATERMARK_DELAY) -> DataFrame:
    return telemetry_windows(rows, ["rpm"], width, delay).select(measure_columns("rpm"))


def lap_windows(
    rows: DataFrame,
    width: str = LAP_WINDOW,
    delay: str = WATERMARK_DELAY,
    latest: bool = False,
) -> DataFrame:
    """Lap state per session and car.

    The state is the maximum of each measure, which at a lap change mixes two laps.
    ``latest`` takes the values of the highest frame instead, and needs rows built
    with ``lap_rows(..., frame=True)``.
    """
    pick = (lambda c: F.max_by(c, "frame_identifier")) if latest else F.max
    aggregates = [
        F.max("session_time").alias("session_time"),
        *[pick(name).alias(name) for name in LAP_MEASURES],
        F.count("*").alias("sample_count"),
    ]
    out = window_aggregate(rows, width, ["session_uid", "car_index"], aggregates, delay)
    return out.select(
        "window_start", "window_end", "session_uid", "session_time", "car_index",
        *LAP_MEASURES, "sample_count",
    )


# --- two levels: per trace parent, then per window ----------------------------------


def trace_windows(
    rows: DataFrame,
    measures: Sequence[str] = MEASURES,
    width: str = TELEMETRY_WINDOW,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Partial aggregates per window, session and trace parent.

    This is the streaming form of "aggregate plus set of trace parents": the trace
    parent is a key, so open-window state is spread evenly over the state store
    instead of growing one array per session.
    """
    aggregates = [
        F.max("session_time").alias("session_time"),
        F.count("*").alias("sample_count"),
    ]
    for name in measures:
        aggregates += [
            F.sum(F.col(name).cast("bigint")).alias(f"sum_{name}"),
            F.count(name).alias(f"count_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    return window_aggregate(rows, width, ["session_uid", "traceparent"], aggregates, delay)


def merge_trace_windows(partials: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Final rows out of :func:`trace_windows`, with the number of links per row.

    Only trace parents that are valid count as links, as only they are written as such.
    All partials of a window close in the same micro-batch, since the watermark is
    one for the whole query, so merging within a batch is exact.
    """
    aggregates = [
        F.max("session_time").alias("session_time"),
        F.sum("sample_count").alias("sample_count"),
        F.count(F.when(traces.is_valid(F.col("traceparent")), 1)).alias("link_count"),
    ]
    for name in measures:
        total = F.sum(f"sum_{name}").cast("double")
        known = F.sum(f"count_{name}")
        aggregates += [
            F.when(known > 0, total / known).alias(f"avg_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.max(f"max_{name}").alias(f"max_{name}"),
        ]
    return partials.groupBy("window_start", "window_end", "session_uid").agg(*aggregates)
