"""Which packets fed which result, as tables of spans and links.

A span row stands for one written result, a link row for one packet behind it.
Links are found by a distinct over the trace parent itself, so their shuffle spreads
evenly however large one session or window is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow.functions import traces

# Span names.
SPEED_SPAN = "speed-aggregation-window"
RPM_SPAN = "rpm-aggregation-window"
PARTICIPANTS_SPAN = "participants-write"
LOBBY_SPAN = "lobby-info-write"

WINDOW = ("window_start", "window_end", "session_uid")


def known_traces(rows: DataFrame) -> DataFrame:
    """Rows that carry a trace parent."""
    return rows.where(F.col("traceparent").isNotNull())


def distinct_traces(rows: DataFrame) -> DataFrame:
    return known_traces(rows).select("traceparent").distinct()


def with_trace_ids(rows: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Replace ``traceparent`` by ``trace_id`` and ``span_id``.

    A trace parent without exactly four parts fails the job, or is left out with
    ``quarantine``; :func:`bad_traces` lists what was left out.
    """
    trace = F.col("traceparent")
    if on_bad == "fail":
        checked = rows.withColumn("traceparent", traces.require_valid(trace))
    elif on_bad == "quarantine":
        checked = rows.where(traces.is_valid(trace))
    else:
        raise ValueError("on_bad is 'fail' or 'quarantine'")
    return checked.select(
        *[c for c in rows.columns if c != "traceparent"],
        traces.trace_id(trace).alias("trace_id"),
        traces.span_id(trace).alias("span_id"),
    )


def bad_traces(rows: DataFrame) -> DataFrame:
    return known_traces(rows).where(~traces.is_valid(F.col("traceparent")))


def packet_spans(rows: DataFrame, span_name: str, on_bad: str = "fail") -> DataFrame:
    """One span with one link per distinct trace parent of the rows written."""
    spans = with_trace_ids(distinct_traces(rows), on_bad)
    return spans.select(F.lit(span_name).alias("span_name"), "trace_id", "span_id", _event(span_name))


def _event(span_name: str) -> Column:
    return F.lit(f"{span_name}_complete").alias("event")


def window_links(rows: DataFrame, width: str) -> DataFrame:
    """Distinct (window, session, trace parent) of telemetry rows."""
    window = F.window("timestamp", width)
    return (
        known_traces(rows)
        .select(
            window["start"].alias("window_start"),
            window["end"].alias("window_end"),
            "session_uid",
            "traceparent",
        )
        .distinct()
    )


def window_spans(aggregates: DataFrame, span_name: str) -> DataFrame:
    """One span per aggregate row that has links (``link_count`` above zero)."""
    return aggregates.where(F.col("link_count") > 0).select(
        F.lit(span_name).alias("span_name"), *WINDOW, "sample_count", "link_count", _event(span_name)
    )


def span_links(links: DataFrame, span_name: str | Sequence[str], on_bad: str = "fail") -> DataFrame:
    """Link rows of :func:`window_spans`; join them on the window columns.

    Spans that share their links are named together and get one row each.
    """
    names = [span_name] if isinstance(span_name, str) else list(span_name)
    known = with_trace_ids(known_traces(links).select(*WINDOW, "traceparent"), on_bad)
    named = F.explode(F.array(*map(F.lit, names))) if len(names) > 1 else F.lit(names[0])
    return known.select(named.alias("span_name"), *WINDOW, "trace_id", "span_id")


def window_lineage(partials: DataFrame, span_name: str, on_bad: str = "fail") -> DataFrame:
    """Spans and links in one table: each link with its window's sample count.

    ``partials`` are rows of ``windows.trace_windows``: its trace parents are the links, and the
    sums of its sample counts those of the windows.  Hand in stored rows, since both sides of the
    join read them.  The window side is small; a window with many links is left to adaptive
    execution, which splits it.
    """
    links = known_traces(partials).select(*WINDOW, "traceparent").alias("link")
    counts = partials.groupBy(*WINDOW).agg(F.sum("sample_count").alias("sample_count")).alias("per_window")
    # NULL-safe, so the group of undecodable packets keeps its rows
    on = reduce(and_, [F.col(f"link.{c}").eqNullSafe(F.col(f"per_window.{c}")) for c in WINDOW])
    joined = links.join(counts, on).select(
        *[F.col(f"link.{c}") for c in WINDOW], "traceparent", "sample_count"
    )
    return with_trace_ids(joined, on_bad).select(
        F.lit(span_name).alias("span_name"), *WINDOW, "sample_count", "trace_id", "span_id"
    )


def packet_attributes(decoded: DataFrame, kinds: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Trace attributes of each decoded packet, with the ``keep`` columns."""

    def header(field: str) -> Column:
        return F.coalesce(*[F.col(f"{kind}.m_header.{field}") for kind in kinds])

    return decoded.where(F.col("packet_kind").isin(*kinds)).select(
        "packet_id",
        header("m_session_uid").alias("session_uid"),
        header("m_frame_identifier").alias("frame_identifier"),
        F.col("packet_kind").alias("packet_type"),
        *keep,
    )


def resolved_links(links: DataFrame, packets: DataFrame, width: str, delay: str) -> DataFrame:
    """Each link with the packet it names: ``packet_id``, ``frame_identifier``, ``packet_type``.

    ``packets`` are :func:`packet_attributes` with ``trace_id``, ``span_id`` and ``timestamp``;
    a packet lies in the window of its link, whose ``width`` bounds what a stream keeps of either
    side.  Trace ids spread evenly, so no session is hot.  On streams a link without a packet
    comes out, with NULLs, once no packet of its window can come any more: ``delay`` after it.
    """

    def bounded(rows: DataFrame, time: str) -> DataFrame:
        return rows.withWatermark(time, delay) if rows.isStreaming else rows

    known = bounded(links, "window_start").alias("link")
    found = bounded(
        packets.select("trace_id", "span_id", "packet_id", "frame_identifier", "packet_type", "timestamp"), "timestamp"
    ).alias("packet")
    start, at = F.col("link.window_start"), F.col("packet.timestamp")
    same = [F.col(f"link.{c}") == F.col(f"packet.{c}") for c in ("trace_id", "span_id")]
    on = reduce(and_, [*same, at >= start, at < start + F.expr(f"INTERVAL {width}")])
    return known.join(found, on, "left").select(
        *[F.col(f"link.{c}") for c in links.columns],
        *[F.col(f"packet.{c}") for c in ("packet_id", "frame_identifier", "packet_type")],
    )
