"""Streaming queries, run to the end of the driver tables and read back.

Each starts the real pipeline on a file source with ``availableNow``.  Tables and
checkpoints go to a fresh folder of the shared scratch directory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddockflow import schemas, scratch
from paddockflow.operators import decode, lineage, serve
from paddockflow.plans import batch, feeds, sql
from paddockflow.plans.batch import LOBBY_SQL, PARTICIPANTS_SQL, plain, query
from paddockflow.sources import datagrams, records, warehouse
from paddockflow.streaming import pipeline
from paddockflow.streaming.sinks import FeedSink

NOW = {"availableNow": True}
HOUR = 3600


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feeds.spread(feeds.stream_table(spark, sf_dir, name), feeds.table(spark, sf_dir, name))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k`` as the session: a real session holds thousands of packets."""
    return by_session(feeds.event_columns(_stream(spark, sf_dir, "events")))


def _name(root: str) -> str:
    """Query name of a run; queries that are active together need different ones."""
    return root.rsplit("/", 1)[1]


def by_session(rows: DataFrame) -> DataFrame:
    return rows.withColumn("user_id", F.col("k").cast("bigint"))


def _event_state(spark: SparkSession, sf_dir: str, least: int | None = None) -> int:
    return feeds.state_partitions(feeds.table(spark, sf_dir, "events"), least)


def _telemetry(spark, sf_dir, **options) -> str:
    root = scratch.new_folder(spark, "telemetry")
    pipeline.start_telemetry(
        feeds.telemetry_records(event_stream(spark, sf_dir)),
        f"{root}/wh", f"{root}/cp", width="1 hour", trigger=NOW, name=_name(root),
        state_partitions=_event_state(spark, sf_dir), **options
    ).awaitTermination()
    return root


def _closed(select: str) -> str:
    return f"SELECT * FROM ({select}) WHERE window_end <= {sql.closed_before(HOUR, 1)}"


@query("stream_speed_table", sql.SESSION_PACKETS + _closed(sql.telemetry_windows(HOUR, ["speed"])))
def stream_speed_table(spark, sf_dir):
    root = _telemetry(spark, sf_dir, with_lineage=False)
    return plain(warehouse.read(spark, f"{root}/wh", "speed_aggregation"))


@query("stream_rpm_table", sql.SESSION_PACKETS + _closed(sql.telemetry_windows(HOUR, ["rpm"])))
def stream_rpm_table(spark, sf_dir):
    root = _telemetry(spark, sf_dir)
    return plain(warehouse.read(spark, f"{root}/wh", "rpm_aggregation"))


@query(
    "stream_speed_feed",
    sql.SESSION_PACKETS
    + f"""SELECT CAST(session_uid AS VARCHAR) AS key, session_uid, window_start, max_speed, sample_count
          FROM ({_closed(sql.telemetry_windows(HOUR, ["speed"]))})""",
)
def stream_speed_feed(spark, sf_dir):
    """The keyed JSON feed that goes out beside the table."""
    out = scratch.new_folder(spark, "feed")
    _telemetry(spark, sf_dir, feeds={"speed": FeedSink("parquet", {"path": out})})
    text = F.from_json("value", schemas.SPEED_FEED).alias("data")
    rows = spark.read.schema("key STRING, value STRING").parquet(out).select("key", text)
    return rows.select(
        "key",
        "data.session_uid",
        F.to_timestamp("data.window_start").cast("timestamp_ntz").alias("window_start"),
        "data.max_speed",
        "data.sample_count",
    )


_STREAM_WINDOWS = f", w AS (SELECT {sql.window_columns(HOUR)}, * FROM t)"


@query(
    "stream_window_spans",
    sql.SESSION_PACKETS
    + _STREAM_WINDOWS
    + f"""
SELECT 'speed-aggregation-window' AS span_name, window_start, window_end, session_uid,
       count(*) AS sample_count, count(DISTINCT traceparent) AS link_count,
       'speed-aggregation-window_complete' AS event
FROM w WHERE window_end <= {sql.closed_before(HOUR, 1)}
GROUP BY ALL HAVING count(DISTINCT traceparent) > 0
""",
)
def stream_window_spans(spark, sf_dir):
    root = _telemetry(spark, sf_dir)
    rows = spark.read.parquet(f"{root}/wh/{pipeline.WINDOW_SPANS}").where(F.col("span_name") == lineage.SPEED_SPAN)
    return plain(rows.drop(warehouse.BATCH))


@query(
    "stream_window_links",
    sql.SESSION_PACKETS
    + _STREAM_WINDOWS
    + f"""
SELECT 'rpm-aggregation-window' AS span_name, window_start, window_end, session_uid,
       md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id
FROM w WHERE traceparent IS NOT NULL AND window_end <= {sql.closed_before(HOUR, 1)}
""",
)
def stream_window_links(spark, sf_dir):
    root = _telemetry(spark, sf_dir)
    rows = spark.read.parquet(f"{root}/wh/{pipeline.WINDOW_LINKS}").where(F.col("span_name") == lineage.RPM_SPAN)
    return plain(rows.drop(warehouse.BATCH))


@query("stream_lap_table", sql.SESSION_PACKETS + _closed(sql.lap_windows(HOUR)))
def stream_lap_table(spark, sf_dir):
    root = scratch.new_folder(spark, "lap")
    pipeline.start_laps(
        feeds.lap_records(event_stream(spark, sf_dir)),
        f"{root}/wh", f"{root}/cp", width="1 hour", trigger=NOW, name=_name(root),
        state_partitions=_event_state(spark, sf_dir),
    ).awaitTermination()
    return plain(warehouse.read(spark, f"{root}/wh", "lap"))


@query("stream_participants_table", f"{PARTICIPANTS_SQL} FROM part")
def stream_participants_table(spark, sf_dir):
    root = scratch.new_folder(spark, "participants")
    packets = feeds.part_records(_stream(spark, sf_dir, "part"))
    pipeline.start_participants(
        packets, f"{root}/wh", f"{root}/cp", trigger=NOW, name=_name(root)
    ).awaitTermination()
    return plain(warehouse.read(spark, f"{root}/wh", "participants"))


@query("stream_lobby_table", f"{LOBBY_SQL} FROM customer")
def stream_lobby_table(spark, sf_dir):
    root = scratch.new_folder(spark, "lobby")
    packets = feeds.customer_records(_stream(spark, sf_dir, "customer"))
    pipeline.start_lobby(
        packets, f"{root}/wh", f"{root}/cp", trigger=NOW, name=_name(root)
    ).awaitTermination()
    return plain(warehouse.read(spark, f"{root}/wh", "lobby_info"))


@query(
    "stream_packet_spans",
    """
SELECT 'lobby-info-write' AS span_name, md5(CAST(c_custkey AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(c_custkey AS VARCHAR)), 1, 16) AS span_id,
       'lobby-info-write_complete' AS event
FROM customer
""",
)
def stream_packet_spans(spark, sf_dir):
    root = scratch.new_folder(spark, "lobby-spans")
    packets = feeds.customer_records(_stream(spark, sf_dir, "customer"))
    pipeline.start_lobby(
        packets, f"{root}/wh", f"{root}/cp", trigger=NOW, name=_name(root)
    ).awaitTermination()
    rows = spark.read.parquet(f"{root}/wh/{pipeline.PACKET_SPANS}/lobby_info")
    return rows.drop(warehouse.BATCH)


# Events arrive in three loads; the second and third hold rows that come too late.  The
# last takes every type that the others don't name.
ARRIVALS = (("click", "view"), ("purchase", "signup"))
DELAY_DAYS = 20

_DAY = 86400
_LATE = f"""
, a AS (
  SELECT *, {sql.start_of(6 * HOUR)} + INTERVAL 6 HOUR AS closes,
         CASE WHEN event_type IN ('click', 'view') THEN 0
              WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 2 END AS load
  FROM t
),
marks AS (
  SELECT load, max(date_trunc('millisecond', max(ts))) OVER (ORDER BY load) - INTERVAL {DELAY_DAYS} DAY AS mark
  FROM a GROUP BY load
),
intime AS (
  SELECT a.* FROM a LEFT JOIN marks m ON m.load = a.load - 1
  WHERE m.mark IS NULL OR a.closes > m.mark
)
"""


@query(
    "stream_late_rows",
    sql.SESSION_PACKETS
    + _LATE
    + f"""SELECT * FROM ({sql.telemetry_windows(6 * HOUR, ["speed"], "intime")})
          WHERE window_end <= (SELECT max(mark) FROM marks)""",
)
def stream_late_rows(spark, sf_dir):
    """Three loads into one query that is stopped and restarted between them."""
    root = scratch.new_folder(spark, "late")
    for _ in late_loads(spark, sf_dir, root):
        pass
    return plain(warehouse.read(spark, f"{root}/wh", "speed_aggregation"))


def late_loads(spark, sf_dir, root, **options):
    """Run the telemetry job on one load after the other; yields each run once it has ended."""
    source = feeds.table(spark, sf_dir, "events")
    kind = F.coalesce("event_type", F.lit(""))
    loads = [kind.isin(*types) for types in ARRIVALS]
    for load in [*loads, ~kind.isin(*[t for types in ARRIVALS for t in types])]:
        source.where(load).write.mode("append").parquet(f"{root}/in")
        arrived = spark.readStream.schema(source.schema).parquet(f"{root}/in")
        job = pipeline.start_telemetry(
            feeds.telemetry_records(by_session(feeds.event_columns(arrived))),
            f"{root}/wh", f"{root}/cp", width="6 hours", delay=f"{DELAY_DAYS} days", trigger=NOW,
            name=_name(root), state_partitions=_event_state(spark, sf_dir), **options
        )
        job.awaitTermination()
        yield job


@query("stream_rerun", sql.SESSION_PACKETS + _closed(sql.lap_windows(HOUR)))
def stream_rerun(spark, sf_dir):
    """A restart from the checkpoint without new input adds no rows."""
    root = scratch.new_folder(spark, "rerun")
    for _ in range(2):
        pipeline.start_laps(
            feeds.lap_records(event_stream(spark, sf_dir)),
            f"{root}/wh", f"{root}/cp", width="1 hour", trigger=NOW,
            name=_name(root), state_partitions=_event_state(spark, sf_dir),
        ).awaitTermination()
    return plain(warehouse.read(spark, f"{root}/wh", "lap"))


@query(
    "stream_first_seen",
    "SELECT event_type, min(event_id) AS first_event_id FROM events GROUP BY event_type",
)
def stream_first_seen(spark, sf_dir):
    """Kinds seen so far, kept up to date by a stream."""
    root = scratch.new_folder(spark, "seen")

    def replace(rows, _batch_id):
        rows.write.mode("overwrite").parquet(f"{root}/seen")

    seen = serve.first_seen(_stream(spark, sf_dir, "events"), "event_type", "event_id")
    (
        seen.writeStream.outputMode("complete").foreachBatch(replace)
        .option("checkpointLocation", f"{root}/cp").trigger(**NOW).start().awaitTermination()
    )
    return spark.read.parquet(f"{root}/seen")


_REJECTS = """
SELECT feed, count(*) AS rejects FROM events, (VALUES ('speed'), ('rpm')) f(feed)
WHERE event_type <> 'click' GROUP BY feed
"""


def _merge(spark, sf_dir) -> str:
    """Both aggregate feeds published as files, read again as streams and merged."""
    root = scratch.new_folder(spark, "merge")
    rows = feeds.event_columns(_stream(spark, sf_dir, "events"))
    for measure in ("speed", "rpm"):
        (
            feeds.aggregate_records(rows, measure).writeStream.format("parquet")
            .option("path", f"{root}/{measure}").option("checkpointLocation", f"{root}/cp/{measure}")
            .trigger(**NOW).start().awaitTermination()
        )
    published = {m: records.stream(spark, "parquet", path=f"{root}/{m}") for m in ("speed", "rpm")}
    pipeline.start_merge(
        published["speed"], published["rpm"],
        FeedSink("parquet", {"path": f"{root}/messages"}), FeedSink("parquet", {"path": f"{root}/rejects"}),
        f"{root}/cp", trigger=NOW, name=_name(root),
    ).awaitTermination()
    return root


@query("stream_feed_merge", batch.ORACLES["feed_merge"])
def stream_feed_merge(spark, sf_dir):
    """Two aggregate feeds, checked and merged into one stream of messages."""
    root = _merge(spark, sf_dir)
    return spark.read.schema("type STRING, message STRING").parquet(f"{root}/messages").select("type", "message")


@query("stream_feed_rejects", _REJECTS)
def stream_feed_rejects(spark, sf_dir):
    """What the merge job refuses of both feeds."""
    root = _merge(spark, sf_dir)
    refused = spark.read.schema("feed STRING, value BINARY").parquet(f"{root}/rejects")
    return refused.groupBy("feed").agg(F.count("*").alias("rejects"))


def _capture(spark, sf_dir, path):
    """Datagrams of all events written as a capture table: its path and schema."""
    captured = feeds.datagrams(by_session(feeds.events(spark, sf_dir)), "car_telemetry")
    captured.write.parquet(path)
    return path, captured.schema


@query(
    "capture_scan",
    """
SELECT event_id, CAST((event_id + CAST(json_extract_string(props, '$.k') AS INT) // 4 * 31) % 100 AS INT) AS speed
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) < 88
""",
)
def capture_scan(spark, sf_dir):
    """Player speeds out of a capture table."""
    path, _ = _capture(spark, sf_dir, scratch.new_folder(spark, "capture"))
    packets = decode.decode_kind(
        datagrams.read(spark, path), "car_telemetry", fields=["m_header", "m_speed"], keep=["event_id"]
    )
    speed = F.get("m_car_telemetry_data", F.col("m_header.m_player_car_index"))["m_speed"]
    return packets.select("event_id", speed.alias("speed")).where("speed is not null")


def _job_sql(job: str, source: str, at: str, number: str) -> str:
    return f"SELECT '{job}' AS job, session_uid, {at} AS at, CAST({number} AS BIGINT) AS number FROM ({source})"


@query(
    "stream_all_jobs",
    sql.SESSION_PACKETS
    + " UNION ALL ".join([
        _job_sql("telemetry", _closed(sql.telemetry_windows(HOUR, ["speed"])), "window_start", "max_speed * 1000 + sample_count"),
        _job_sql("telemetry", _closed(sql.telemetry_windows(HOUR, ["rpm"])), "window_start", "max_rpm * 1000 + sample_count"),
        _job_sql("lap", _closed(sql.lap_windows(HOUR)), "window_start", "current_lap_time_ms * 100 + car_index"),
        _job_sql("participants", f"{PARTICIPANTS_SQL} FROM part", '"timestamp"', "driver_id * 1000 + team_id"),
        _job_sql("lobby_info", f"{LOBBY_SQL} FROM customer", '"timestamp"', "team_id * 1000 + car_number"),
    ]),
)
def stream_all_jobs(spark, sf_dir):
    """All four jobs started together, each to the end of its feed, with the rows that each wrote."""
    root = scratch.new_folder(spark, "all")
    events = event_stream(spark, sf_dir)
    sources = {
        "telemetry": feeds.telemetry_records(events),
        "lap": feeds.lap_records(events),
        "participants": feeds.part_records(_stream(spark, sf_dir, "part")),
        "lobby_info": feeds.customer_records(_stream(spark, sf_dir, "customer")),
    }
    options = {job: {"trigger": NOW, "name": f"{job}-{_name(root)}"} for job in sources}
    for job in ("telemetry", "lap"):
        options[job] |= {"width": "1 hour", "state_partitions": _event_state(spark, sf_dir, 8)}
    for started in pipeline.start_all(sources, f"{root}/wh", f"{root}/cp", options=options):
        started.awaitTermination()

    def written(job, table, at, number):
        rows = plain(warehouse.read(spark, f"{root}/wh", table))
        return rows.select(F.lit(job).alias("job"), "session_uid", F.col(at).alias("at"), F.expr(number).cast("bigint").alias("number"))

    tables = [
        written("telemetry", "speed_aggregation", "window_start", "max_speed * 1000 + sample_count"),
        written("telemetry", "rpm_aggregation", "window_start", "max_rpm * 1000 + sample_count"),
        written("lap", "lap", "window_start", "current_lap_time_ms * 100 + car_index"),
        written("participants", "participants", "timestamp", "driver_id * 1000 + team_id"),
        written("lobby_info", "lobby_info", "timestamp", "team_id * 1000 + car_number"),
    ]
    return reduce(DataFrame.unionByName, tables)


@query("stream_timed_trigger", f"{LOBBY_SQL} FROM customer")
def stream_timed_trigger(spark, sf_dir):
    """Lobby rows of a job on its own 30 s trigger, stopped once its feed has been read."""
    root = scratch.new_folder(spark, "timed")
    packets = feeds.customer_records(_stream(spark, sf_dir, "customer"))
    job = pipeline.start_lobby(packets, f"{root}/wh", f"{root}/cp", name=_name(root))
    pipeline.run_until_read(job)
    return plain(warehouse.read(spark, f"{root}/wh", "lobby_info"))


@query(
    "stream_datagram_chain",
    sql.SESSION_PACKETS.replace("CAST(floor(value) AS INT) + car", "CAST((event_id + car * 31) % 100 AS INT)")
    .replace("AND k < 10", "AND k < 0")
    + _closed(sql.telemetry_windows(HOUR, ["speed"])),
)
def stream_datagram_chain(spark, sf_dir):
    """Two jobs in line: a capture of datagrams to a record feed, and that feed to the speed table."""
    root = scratch.new_folder(spark, "chain")
    number = F.col("event_id").cast("string")
    pipeline.start_publish(
        datagrams.read_stream(spark, *_capture(spark, sf_dir, f"{root}/capture")),
        FeedSink("parquet", {"path": f"{root}/records"}),
        f"{root}/cp",
        F.md5(number),
        F.substring(F.md5(F.concat(F.lit("s"), number)), 1, 16),
        keep=["timestamp"],
        trigger=NOW,
        name=f"publish-{_name(root)}",
    ).awaitTermination()
    published = records.stream(spark, "parquet", path=f"{root}/records")
    pipeline.start_telemetry(
        published, f"{root}/wh", f"{root}/cp", width="1 hour", trigger=NOW, name=_name(root),
        state_partitions=_event_state(spark, sf_dir),
    ).awaitTermination()
    return plain(warehouse.read(spark, f"{root}/wh", "speed_aggregation"))


@query("warehouse_scan", f"{PARTICIPANTS_SQL} FROM part")
def warehouse_scan(spark, sf_dir):
    """Tables declared over a warehouse folder show what a sink wrote there."""
    root = scratch.new_folder(spark, "warehouse")
    packets = feeds.part_records(_stream(spark, sf_dir, "part"))
    pipeline.start_participants(
        packets, f"{root}/wh", f"{root}/cp", trigger=NOW, name=_name(root)
    ).awaitTermination()
    database = "wh_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    for _ in range(2):
        warehouse.create_tables(spark, f"{root}/wh", database)
    warehouse.refresh_tables(spark, [f"{database}.participants"])
    return plain(spark.table(f"{database}.participants").select(*schemas.names("participants")))
