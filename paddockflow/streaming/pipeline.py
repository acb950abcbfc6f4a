"""The streaming jobs: packet feeds in, aggregate feeds and warehouse tables out.

Speed and revs come from one query, since both read the telemetry feed with the same
windows.  Each query needs its own checkpoint folder on shared storage.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paddockflow import schemas
from paddockflow.operators import decode, envelope, lineage, project, serve, windows
from paddockflow.sources import layouts
from paddockflow.streaming import counts, live
from paddockflow.streaming.sinks import FeedSink, append_lineage, append_table, held, kept, single

# Fixed value: trigger of the two dimension queries.
DIMENSION_TRIGGER = {"processingTime": "30 seconds"}

WINDOW_SPANS = "window_spans"
WINDOW_LINKS = "window_links"
PACKET_SPANS = "packet_spans"
BAD_TRACES = "bad_traces"
LIVE_CHANGES = "live_changes"
LATE_WINDOWS = "late_windows"
RESOLVED_LINKS = "resolved_links"

_MEASURES = {
    "speed": ("speed_aggregation", lineage.SPEED_SPAN),
    "rpm": ("rpm_aggregation", lineage.RPM_SPAN),
}


def _start(
    rows: DataFrame, name: str, action, checkpoints: str, trigger: dict | None, state_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """``state_partitions`` splits the state of a query whose checkpoint is new; it can't change later.

    ``settings`` hold for this query alone: a query takes the session's settings when it starts.
    """
    conf = rows.sparkSession.conf
    wanted = dict(settings or {})
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {setting: conf.get(setting, None) for setting in wanted}
    writer = (
        rows.writeStream.queryName(name)
        .foreachBatch(action)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
    )
    try:
        for setting, value in wanted.items():
            conf.set(setting, value)
        return (writer.trigger(**trigger) if trigger else writer).start()
    finally:
        for setting, value in before.items():
            if value is None:
                conf.unset(setting)
            else:
                conf.set(setting, value)


def start_telemetry(
    records: DataFrame,
    warehouse: str,
    checkpoints: str,
    feeds: dict[str, FeedSink] | None = None,
    clock: str = "timestamp",
    width: str = windows.TELEMETRY_WINDOW,
    delay: str = windows.WATERMARK_DELAY,
    on_bad_trace: str = "fail",
    trigger: dict | None = None,
    name: str = "telemetry",
    with_lineage: bool = True,
    state_partitions: int | None = None,
    observe: bool = False,
) -> StreamingQuery:
    """Windows of speed and revs to their feeds, then to their tables, with lineage.

    ``feeds`` maps ``speed`` and ``rpm`` to their sinks; a measure without one only
    goes to its table.  Without lineage the state has one row per window instead of one
    per packet.  Links are the same for both measures and are written once, with the span
    names as a column; bad trace parents go to their own table under ``quarantine``.  With
    ``observe`` each batch counts its rows and those that hold no packet (see ``counts``).
    """
    feeds = feeds or {}

    def write_measures(merged: DataFrame, batch: str) -> None:
        for measure, (table, _) in _MEASURES.items():
            rows = merged.select(*windows.measure_columns(measure))
            if measure in feeds:
                feeds[measure].write(envelope.feed_records(rows), batch)
            append_table(rows, warehouse, table, batch)

    def write(partials: DataFrame, batch: str) -> None:
        names = [span for _, span in _MEASURES.values()]
        with held(windows.merge_trace_windows(partials)) as merged:
            write_measures(merged, batch)
            spans = reduce(DataFrame.unionByName, [lineage.window_spans(merged, span) for span in names])
            append_lineage(spans, warehouse, WINDOW_SPANS, batch)
        append_lineage(lineage.span_links(partials, names, on_bad_trace), warehouse, WINDOW_LINKS, batch)
        if on_bad_trace == "quarantine":
            bad = lineage.bad_traces(partials).select(*lineage.WINDOW, "traceparent")
            append_lineage(bad, warehouse, BAD_TRACES, batch)

    packets = envelope.read_packets(records, schemas.TELEMETRY_JSON)
    if observe:
        packets = counts.observed(packets, F.col("m_header").isNull())
    rows = project.telemetry_rows(packets, clock)
    if with_lineage:
        partials = windows.trace_windows(rows, width=width, delay=delay)
        return _start(partials, name, kept(write), checkpoints, trigger, state_partitions)
    merged = windows.telemetry_windows(rows, width=width, delay=delay)
    return _start(merged, name, kept(write_measures), checkpoints, trigger, state_partitions)


def start_laps(
    records: DataFrame,
    warehouse: str,
    checkpoints: str,
    clock: str = "timestamp",
    width: str = windows.LAP_WINDOW,
    delay: str = windows.WATERMARK_DELAY,
    trigger: dict | None = None,
    name: str = "lap",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Lap windows to their table."""

    def write(rows: DataFrame, batch: str) -> None:
        append_table(rows, warehouse, "lap", batch)

    packets = envelope.read_packets(records, schemas.LAP_JSON)
    rows = windows.lap_windows(project.lap_rows(packets, clock), width, delay)
    return _start(rows, name, single(write), checkpoints, trigger, state_partitions)


def _start_dimension(rows, table, span, warehouse, checkpoints, on_bad_trace, trigger, name):
    def write(batch_rows: DataFrame, batch: str) -> None:
        append_lineage(
            lineage.packet_spans(batch_rows, span, on_bad_trace),
            warehouse, f"{PACKET_SPANS}/{table}", batch,
        )
        append_table(batch_rows.select(*schemas.names(table)), warehouse, table, batch)
        if on_bad_trace == "quarantine":
            bad = lineage.bad_traces(batch_rows).select("traceparent").distinct()
            append_lineage(bad, warehouse, f"{BAD_TRACES}_{table}", batch)

    return _start(rows, name, kept(write), checkpoints, trigger)


def start_participants(
    records: DataFrame,
    warehouse: str,
    checkpoints: str,
    clock: str = "timestamp",
    on_bad_trace: str = "fail",
    trigger: dict | None = DIMENSION_TRIGGER,
    name: str = "participants",
) -> StreamingQuery:
    """Driver rows to their table, one per packet."""
    packets = envelope.read_packets(records, schemas.PARTICIPANTS_JSON)
    rows = project.participant_rows(packets, clock)
    return _start_dimension(
        rows, "participants", lineage.PARTICIPANTS_SPAN, warehouse, checkpoints, on_bad_trace, trigger, name
    )


def start_lobby(
    records: DataFrame,
    warehouse: str,
    checkpoints: str,
    clock: str = "timestamp",
    on_bad_trace: str = "fail",
    trigger: dict | None = DIMENSION_TRIGGER,
    name: str = "lobby-info",
) -> StreamingQuery:
    """Lobby rows to their table, one per packet."""
    packets = envelope.read_packets(records, schemas.LOBBY_JSON)
    rows = project.lobby_rows(packets, clock)
    return _start_dimension(
        rows, "lobby_info", lineage.LOBBY_SPAN, warehouse, checkpoints, on_bad_trace, trigger, name
    )


def start_publish(
    datagrams: DataFrame,
    feed: FeedSink,
    checkpoints: str,
    trace_id: Column,
    span_id: Column,
    topics: dict[str, str] | None = None,
    keep: Sequence[str] = (),
    trigger: dict | None = None,
    name: str = "publish",
) -> StreamingQuery:
    """Captured datagrams to keyed JSON records of the published kinds.

    ``trace_id`` and ``span_id`` are expressions over the datagram's columns.  They
    should depend on the datagram alone, so that a replayed batch keeps its traces.  Records
    are ten times the size of their datagrams, so they are written where they are made.
    """
    kinds = list(layouts.PUBLISHED)
    traced = datagrams.withColumns({"_trace_id": trace_id, "_span_id": span_id})
    decoded = decode.decode(traced, kinds, keep=[*keep, "_trace_id", "_span_id"], nan_as_null=True)
    records = envelope.packet_records(
        decoded, kinds, F.col("_trace_id"), F.col("_span_id"), keep=keep, topics=topics
    )

    def write(batch_rows: DataFrame, batch: str) -> None:
        feed.write(batch_rows, batch, gather=False)

    return _start(records, name, single(write), checkpoints, trigger)


def start_merge(
    speed_records: DataFrame,
    rpm_records: DataFrame,
    messages: FeedSink,
    rejects: FeedSink,
    checkpoints: str,
    trigger: dict | None = None,
    name: str = "merge",
) -> StreamingQuery:
    """Both aggregate feeds into one feed of tagged messages, what is not valid into another."""

    def named(records: DataFrame, feed: str) -> DataFrame:
        return records.select(F.lit(feed).alias("feed"), "value")

    def write(batch_rows: DataFrame, batch: str) -> None:
        feeds = {feed: batch_rows.where(F.col("feed") == feed) for feed in ("speed", "rpm")}
        messages.write(envelope.merge_feeds(feeds["speed"], feeds["rpm"]), batch)
        refused = [envelope.reject_feed(rows, feed) for feed, rows in feeds.items()]
        rejects.write(reduce(DataFrame.unionByName, refused), batch)

    both = named(speed_records, "speed").unionByName(named(rpm_records, "rpm"))
    return _start(both, name, kept(write), checkpoints, trigger)


def start_merge_once(
    speed_records: DataFrame,
    rpm_records: DataFrame,
    messages: FeedSink,
    checkpoints: str,
    delay: str = "1 minute",
    trigger: dict | None = None,
    name: str = "merge-once",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Both aggregate feeds into one feed of tagged messages, without those a replay wrote twice.

    The feeds are written at least once; ``delay`` is how far behind the newest window a second
    copy may come.  :func:`start_merge` has the rejects.
    """

    def write(rows: DataFrame, batch: str) -> None:
        messages.write(rows, batch)

    once = envelope.messages_once(speed_records, rpm_records, delay)
    return _start(once, name, single(write), checkpoints, trigger, state_partitions)


def start_resolution(
    links: DataFrame,
    packets: DataFrame,
    warehouse: str,
    checkpoints: str,
    width: str = windows.TELEMETRY_WINDOW,
    delay: str = "1 minute",
    trigger: dict | None = None,
    name: str = "resolve-links",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Links of windows with the packets they name, to the table ``resolved_links``."""

    def write(rows: DataFrame, batch: str) -> None:
        append_lineage(rows, warehouse, RESOLVED_LINKS, batch)

    resolved = lineage.resolved_links(links, packets, width, delay)
    return _start(resolved, name, single(write), checkpoints, trigger, state_partitions)


def start_live(
    rows: DataFrame,
    warehouse: str,
    checkpoints: str,
    kind: str,
    order: Sequence[str],
    n: int = serve.HISTORY_ROWS,
    trigger: dict | None = None,
    name: str = "live",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Changes of every kind's latest row and last ``n`` rows to the table ``live_changes``."""

    def write(changes: DataFrame, batch: str) -> None:
        append_lineage(changes, warehouse, LIVE_CHANGES, batch)

    changes = live.live_changes(rows, kind, order, n)
    return _start(changes, name, single(write), checkpoints, trigger, state_partitions, live.KEYED_STATE)


def start_closing_telemetry(
    records: DataFrame,
    warehouse: str,
    checkpoints: str,
    seconds: int = 1,
    delay_seconds: float = 1,
    idle_seconds: float = 30,
    clock: str = "timestamp",
    trigger: dict | None = None,
    name: str = "closing-telemetry",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Windows of speed and revs to their tables, those of a stalled session after ``idle_seconds``.

    What came too late goes to the table ``late_windows``.
    """

    def write(closed: DataFrame, batch: str) -> None:
        in_time = closed.where(F.col("closed_by") != live.LATE)
        for measure, (table, _) in _MEASURES.items():
            append_table(in_time.select(*windows.measure_columns(measure)), warehouse, table, batch)
        append_lineage(closed.where(F.col("closed_by") == live.LATE).drop("closed_by"), warehouse, LATE_WINDOWS, batch)

    rows = project.telemetry_rows(envelope.read_packets(records, schemas.TELEMETRY_JSON), clock)
    closed = live.closing_windows(rows, seconds=seconds, delay_seconds=delay_seconds, idle_seconds=idle_seconds)
    return _start(closed, name, kept(write), checkpoints, trigger, state_partitions, live.KEYED_STATE)


def start_all(
    sources: dict[str, DataFrame],
    warehouse: str,
    checkpoints: str,
    feeds: dict[str, FeedSink] | None = None,
    clock: str = "timestamp",
    on_bad_trace: str = "fail",
    options: dict[str, dict] | None = None,
) -> list[StreamingQuery]:
    """Start every query whose feed is given: telemetry, lap, participants, lobby_info.

    ``options`` holds further arguments of each query's own start function by the same names,
    such as ``trigger``, ``width``, ``delay`` or ``state_partitions``.
    """
    for records in sources.values():
        records.sparkSession.streams.resetTerminated()  # wait for these queries, not older ones
    traced = {"on_bad_trace": on_bad_trace}
    jobs = {
        "telemetry": (start_telemetry, {"feeds": feeds, **traced}),
        "lap": (start_laps, {}),
        "participants": (start_participants, traced),
        "lobby_info": (start_lobby, traced),
    }
    return [
        start(sources[job], warehouse, checkpoints, **{"clock": clock, **fixed, **(options or {}).get(job, {})})
        for job, (start, fixed) in jobs.items()
        if job in sources
    ]


def run_until_one_ends(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for the first query to end, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def run_until_quiet(query: StreamingQuery, seconds: float, poll: float = 0.1) -> None:
    """Stop a query once nothing came in for so long and a batch has run since.

    For queries with timers of their own, whose batches go on without input: by then the timers
    of what has stalled have fired.
    """

    def at(progress) -> float:
        return datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp()

    began = time.time()
    try:
        while query.isActive:
            seen = query.recentProgress
            busy = [at(p) + p["durationMs"].get("triggerExecution", 0) / 1000 for p in seen if p["numInputRows"]]
            quiet_since = max([began, *busy])
            if any(not p["numInputRows"] and at(p) >= quiet_since + seconds for p in seen):
                break
            time.sleep(poll)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()


def run_until_read(query: StreamingQuery, poll: float = 0.1) -> None:
    """Stop a query on a timed trigger after the first batch with rows; later rows stay for a restart."""
    try:
        while query.isActive and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(poll)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
