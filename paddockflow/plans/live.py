"""Queries over state kept by key: live histories, stalled sessions, replayed feeds, resolved links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddockflow import scratch
from paddockflow.operators import decode, lineage, serve, windows
from paddockflow.plans import batch, feeds, sql
from paddockflow.plans.batch import plain, query
from paddockflow.plans.streams import _LATE, NOW, _event_state, _name, _telemetry, by_session, event_stream, late_loads
from paddockflow.sources import captures, datagrams, records, warehouse
from paddockflow.streaming import counts, live, pipeline
from paddockflow.streaming.sinks import FeedSink

DAY = 86400
#: Events arrive in so many loads; each holds every so-manieth event, so that loads overlap in time.
LOADS = 3
STATE = 8
#: Bytes of a capture file that one task reads: some thousand datagrams.
_SPLIT = 1 << 23


def _loads(spark, sf_dir, root):
    """Write one load after the other; yields its number and the stream over what is there."""
    source = feeds.table(spark, sf_dir, "events")
    for load in range(LOADS):
        source.where(F.pmod(F.col("event_id"), F.lit(LOADS)) == load).write.mode("append").parquet(f"{root}/in")
        yield load, spark.readStream.schema(source.schema).parquet(f"{root}/in")


def _after_each_load(spark, sf_dir, view) -> DataFrame:
    """``view`` of the changes known after each load; the job stops and starts again between them."""
    root = scratch.new_folder(spark, "live")
    seen = []
    for load, arrived in _loads(spark, sf_dir, root):
        rows = arrived.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id", "event_type", "value")
        pipeline.start_live(
            rows, f"{root}/wh", f"{root}/cp", "event_type", ["ts", "event_id"], trigger=NOW, name=_name(root),
            state_partitions=STATE,
        ).awaitTermination()
        changes = spark.read.parquet(f"{root}/wh/{pipeline.LIVE_CHANGES}").drop(warehouse.BATCH)
        known = view(changes).select(F.lit(load).alias("load"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                                     *[c for c in ("event_id", "user_id", "event_type", "value", "recency")
                                       if c != "recency" or view is _history])
        seen.append(scratch.saved(known, "live-view"))
    return reduce(DataFrame.unionByName, seen)


def _history(changes: DataFrame) -> DataFrame:
    return serve.last_n(live.history_of(changes), "event_type", ["ts", "event_id"])


def _latest(changes: DataFrame) -> DataFrame:
    return live.latest_of(changes, "event_type", "ts", "event_id")


_KNOWN = f"""
SELECT l.load, e.event_id, e.ts, e.user_id, e.event_type, e.value,
       CAST(row_number() OVER (PARTITION BY l.load, e.event_type ORDER BY e.ts DESC, e.event_id DESC) AS INT) AS recency
FROM events e JOIN (SELECT CAST(unnest(range({LOADS})) AS INT) AS load) l ON e.event_id % {LOADS} <= l.load
"""


@query("stream_live_history", f"SELECT * FROM ({_KNOWN}) WHERE recency <= 50")
def stream_live_history(spark, sf_dir):
    """The last 50 events of each type after each of three loads, out of kept state."""
    return _after_each_load(spark, sf_dir, _history)


@query("stream_live_latest", f"SELECT * EXCLUDE (recency) FROM ({_KNOWN}) WHERE recency = 1")
def stream_live_latest(spark, sf_dir):
    """The latest event of each type after each of three loads, out of kept state."""
    return _after_each_load(spark, sf_dir, _latest)


@query("stream_stalled_windows", sql.SESSION_PACKETS + sql.telemetry_windows(DAY, ["speed"]))
def stream_stalled_windows(spark, sf_dir):
    """Every window of sessions that stop sending, the last ones too, and each once over restarts."""
    root = scratch.new_folder(spark, "stalled")
    idle = 0.5
    for _ in range(2):  # the second run has nothing new and nothing left to close
        job = pipeline.start_closing_telemetry(
            feeds.telemetry_records(event_stream(spark, sf_dir)), f"{root}/wh", f"{root}/cp", seconds=DAY,
            idle_seconds=idle, trigger={"processingTime": "500 milliseconds"}, name=_name(root), state_partitions=STATE,
        )
        pipeline.run_until_quiet(job, idle)
    return plain(warehouse.read(spark, f"{root}/wh", "speed_aggregation"))


# --- feeds written twice, links to packets --------------------------------------------------


@query("stream_merge_once", batch.ORACLES["feed_merge"])
def stream_merge_once(spark, sf_dir):
    """Both aggregate feeds, each written twice, as one stream that has every message once."""
    root = scratch.new_folder(spark, "once")
    rows = feeds.events(spark, sf_dir)
    # every event gives a message of each feed
    parts = _event_state(spark, sf_dir, STATE)
    for _ in range(2):  # a job that failed after its write, and its replay
        for measure in ("speed", "rpm"):
            feeds.aggregate_records(rows, measure).write.mode("append").parquet(f"{root}/{measure}")
        published = {m: records.stream(spark, "parquet", path=f"{root}/{m}") for m in ("speed", "rpm")}
        pipeline.start_merge_once(
            published["speed"], published["rpm"], FeedSink("parquet", {"path": f"{root}/messages"}), f"{root}/cp",
            delay="1000 days", trigger=NOW, name=_name(root), state_partitions=parts,
        ).awaitTermination()
    return spark.read.schema("type STRING, message STRING").parquet(f"{root}/messages").select("type", "message")


_RESOLVED = (
    sql.SESSION_PACKETS
    + f"""
, w AS (SELECT {sql.window_columns(3600)}, * FROM t),
links AS (
  SELECT * FROM w WHERE traceparent IS NOT NULL AND window_end <= {sql.closed_before(3600, 1)}
),
mark AS (
  SELECT least((SELECT max(window_start) FROM links),
               (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type <> 'error')) - INTERVAL 1 HOUR AS at
)
SELECT 'speed-aggregation-window' AS span_name, window_start, window_end, session_uid,
       md5(CAST(event_id AS VARCHAR)) AS trace_id, substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id,
       CASE WHEN event_type <> 'error' THEN 6 END AS packet_id,
       CASE WHEN event_type <> 'error' THEN event_id END AS frame_identifier,
       CASE WHEN event_type <> 'error' THEN 'car_telemetry' END AS packet_type
FROM links, mark WHERE event_type <> 'error' OR window_end <= mark.at
"""
)


@query("stream_resolved_links", _RESOLVED)
def stream_resolved_links(spark, sf_dir):
    """Links of speed windows joined to the packets they name; errors were never captured."""
    root = _telemetry(spark, sf_dir)
    captured = feeds.datagrams(by_session(feeds.events(spark, sf_dir)).where("event_type <> 'error'"), "car_telemetry")
    captured.write.parquet(f"{root}/capture")
    decoded = decode.decode(
        datagrams.read_stream(spark, f"{root}/capture", captured.schema), ["car_telemetry"],
        keep=["event_id", "timestamp"], fields={"car_telemetry": ["m_header"]},
    )
    number = F.col("event_id").cast("string")
    traced = decoded.withColumns(
        {"trace_id": F.md5(number), "span_id": F.substring(F.md5(F.concat(F.lit("s"), number)), 1, 16)}
    )
    packets = lineage.packet_attributes(traced, ["car_telemetry"], keep=["trace_id", "span_id", "timestamp"])
    written = f"{root}/wh/{pipeline.WINDOW_LINKS}"
    links = (
        spark.readStream.schema(spark.read.parquet(written).schema).parquet(written)
        .where(F.col("span_name") == lineage.SPEED_SPAN).drop(warehouse.BATCH)
    )
    pipeline.start_resolution(
        links, packets, f"{root}/wh", f"{root}/cp", width="1 hour", delay="1 hour", trigger=NOW,
        name=f"resolve-{_name(root)}", state_partitions=_event_state(spark, sf_dir, STATE),
    ).awaitTermination()
    return plain(spark.read.parquet(f"{root}/wh/{pipeline.RESOLVED_LINKS}").drop(warehouse.BATCH))


# --- counted loss and open windows ----------------------------------------------------------


@query(
    "stream_loss_counts",
    sql.SESSION_PACKETS
    + _LATE
    + f"""
, late AS (
  SELECT a.load, count(DISTINCT (a.closes, session_uid IS NULL, session_uid, traceparent IS NULL, traceparent)) AS late_groups
  FROM a JOIN marks m ON m.load = a.load - 1 WHERE a.closes <= m.mark GROUP BY a.load
)
SELECT CAST(a.load AS BIGINT) AS load, count(*) AS rows_in, count(*) FILTER (broken) AS rows_refused,
       CAST(coalesce(max(late_groups), 0) AS BIGINT) AS late_groups
FROM a LEFT JOIN late USING (load) GROUP BY a.load
""",
)
def stream_loss_counts(spark, sf_dir):
    """Rows in, rows without a packet, and late groups of each of three loads."""
    root = scratch.new_folder(spark, "loss")
    with counts.BatchCounts(spark, f"{root}/counts") as kept:
        for job in late_loads(spark, sf_dir, root, observe=True):
            kept.wait(str(job.runId))
    of_batch = kept.table().where("rows_in > 0 or late_groups > 0")
    load = F.row_number().over(Window.orderBy("batch_id")) - 1
    return of_batch.select(load.cast("bigint").alias("load"), "rows_in", "rows_refused", "late_groups")


@query("stream_open_windows", sql.SESSION_PACKETS + sql.telemetry_windows(3600, ["speed"]))
def stream_open_windows(spark, sf_dir):
    """Windows that are out, with those that the state still holds: all windows of the input."""
    root = _telemetry(spark, sf_dir, with_lineage=False)
    closed = plain(warehouse.read(spark, f"{root}/wh", "speed_aggregation"))
    held = windows.open_telemetry_windows(counts.open_windows(spark, f"{root}/cp/{_name(root)}"))
    return closed.unionByName(plain(held.select(*windows.measure_columns("speed"))))


# --- capture files ----------------------------------------------------------------------------


@query(
    "capture_file_scan",
    """
SELECT event_id, ts AS timestamp, CAST((event_id + CAST(json_extract_string(props, '$.k') AS INT) // 4 * 31) % 100 AS INT) AS speed
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) < 88
""",
)
def capture_file_scan(spark, sf_dir):
    """Player speeds out of capture files, each read by several tasks."""
    path = scratch.new_folder(spark, "captures")
    captures.write(feeds.datagrams(by_session(feeds.events(spark, sf_dir)), "car_telemetry"), path)
    packets = decode.decode_kind(
        captures.read(spark, path, split_bytes=_SPLIT), "car_telemetry", fields=["m_header", "m_speed"], keep=["timestamp"]
    )
    speed = F.get("m_car_telemetry_data", F.col("m_header.m_player_car_index"))["m_speed"]
    return plain(packets.select(F.col("m_header.m_frame_identifier").alias("event_id"), "timestamp", speed.alias("speed"))).where(
        "speed is not null"
    )


@query(
    "stream_capture_files",
    "SELECT event_id AS frame, CAST((event_id + 21 * 31) % 100 AS BIGINT) AS last_car_value FROM events",
)
def stream_capture_files(spark, sf_dir):
    """Captures that grow between two runs of the publishing job: every datagram once."""
    root = scratch.new_folder(spark, "captures")
    rows = by_session(feeds.events(spark, sf_dir))
    place = F.concat_ws("@", F.col("source"), F.col("offset").cast("string"))
    for first in (True, False):
        load = rows.where((F.col("event_id") % 2 == 0) == F.lit(first))
        captures.write(feeds.datagrams(load, "car_telemetry"), f"{root}/in")
        pipeline.start_publish(
            captures.read_stream(spark, f"{root}/in", split_bytes=_SPLIT),
            FeedSink("parquet", {"path": f"{root}/records"}), f"{root}/cp",
            F.md5(place), F.substring(F.md5(F.concat(F.lit("s"), place)), 1, 16), keep=["timestamp"], trigger=NOW,
            name=_name(root),
        ).awaitTermination()
    packet = "m_header STRUCT<m_frame_identifier: BIGINT>, m_car_telemetry_data ARRAY<STRUCT<m_speed: BIGINT>>"
    read = spark.read.parquet(f"{root}/records").select(F.from_json("value", packet).alias("packet"))
    return read.select(
        F.col("packet.m_header.m_frame_identifier").alias("frame"),
        F.get("packet.m_car_telemetry_data", F.lit(21))["m_speed"].alias("last_car_value"),
    )
