"""Window, projection, envelope and lineage queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddockflow import schemas, scratch
from paddockflow.functions import packets as packet_columns
from paddockflow.functions import traces
from paddockflow.operators import envelope, lineage, project, windows
from paddockflow.plans import feeds, sql

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    """Register a (spark, sf_dir) function and its check SQL."""

    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def plain(rows: DataFrame) -> DataFrame:
    """Types the check SQL can hold: times without zone, floats as doubles."""
    casts = {"timestamp": "timestamp_ntz", "float": "double"}
    return rows.select(
        *[F.col(c).cast(casts[t]).alias(c) if t in casts else F.col(c) for c, t in rows.dtypes]
    )


# --- inputs -------------------------------------------------------------------------


def telemetry_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feeds.telemetry_records(feeds.events(spark, sf_dir))
    return envelope.read_packets(records, schemas.TELEMETRY_JSON)


def telemetry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.telemetry_rows(telemetry_packets(spark, sf_dir))


def lap_rows(spark: SparkSession, sf_dir: str, frame: bool = False) -> DataFrame:
    records = feeds.lap_records(feeds.events(spark, sf_dir))
    return project.lap_rows(envelope.read_packets(records, schemas.LAP_JSON), frame=frame)


# --- windows ------------------------------------------------------------------------


@query("speed_window_1s", sql.PACKETS + sql.telemetry_windows(1, ["speed"]))
def speed_window_1s(spark, sf_dir):
    return plain(windows.speed_windows(telemetry_rows(spark, sf_dir)))


@query("rpm_window_1s", sql.PACKETS + sql.telemetry_windows(1, ["rpm"]))
def rpm_window_1s(spark, sf_dir):
    return plain(windows.rpm_windows(telemetry_rows(spark, sf_dir)))


@query("speed_window_1h", sql.PACKETS + sql.telemetry_windows(3600, ["speed"]))
def speed_window_1h(spark, sf_dir):
    return plain(windows.speed_windows(telemetry_rows(spark, sf_dir), "1 hour"))


@query("telemetry_window_1d", sql.PACKETS + sql.telemetry_windows(86400))
def telemetry_window_1d(spark, sf_dir):
    return plain(windows.telemetry_windows(telemetry_rows(spark, sf_dir), width="1 day"))


@query("lap_window_5s", sql.PACKETS + sql.lap_windows(5))
def lap_window_5s(spark, sf_dir):
    return plain(windows.lap_windows(lap_rows(spark, sf_dir)))


@query("lap_window_7d", sql.PACKETS + sql.lap_windows(7 * 86400))
def lap_window_7d(spark, sf_dir):
    return plain(windows.lap_windows(lap_rows(spark, sf_dir), "7 days"))


_LATEST = ", ".join(f"arg_max_null({c}, frame) AS {c}" for c in sql.LAP_FIELDS)


@query(
    "lap_window_latest_7d",
    sql.PACKETS
    + f"""
SELECT {sql.window_columns(7 * 86400)}, session_uid, car_index,
       CAST(max(session_time) AS DOUBLE) AS session_time, {_LATEST}, count(*) AS sample_count
FROM l GROUP BY ALL
""",
)
def lap_window_latest_7d(spark, sf_dir):
    rows = lap_rows(spark, sf_dir, frame=True)
    return plain(windows.lap_windows(rows, "7 days", latest=True))


@query(
    "window_link_counts_1d",
    sql.PACKETS
    + sql.telemetry_windows(86400).replace(
        "count(*) AS sample_count",
        "count(*) AS sample_count, count(DISTINCT traceparent) AS link_count",
    ),
)
def window_link_counts_1d(spark, sf_dir):
    """The streaming form of the aggregate: per trace parent, then merged."""
    partials = windows.trace_windows(telemetry_rows(spark, sf_dir), width="1 day")
    return plain(windows.merge_trace_windows(partials))


# --- projections --------------------------------------------------------------------


@query(
    "json_decode",
    sql.PACKETS
    + """
SELECT session_uid, CAST(session_time AS DOUBLE) AS session_time, frame AS frame_identifier,
       car_index, CASE WHEN NOT broken THEN 22 END AS cars, traceparent, ts AS "timestamp"
FROM p
""",
)
def json_decode(spark, sf_dir):
    header = F.col("m_header")
    return plain(
        telemetry_packets(spark, sf_dir).select(
            header["m_session_uid"].alias("session_uid"),
            header["m_session_time"].alias("session_time"),
            header["m_frame_identifier"].alias("frame_identifier"),
            header["m_player_car_index"].alias("car_index"),
            F.when(F.col("m_car_telemetry_data").isNotNull(), F.size("m_car_telemetry_data")).alias("cars"),
            "traceparent",
            "timestamp",
        )
    )


@query("header_lookup", sql.PACKETS + "SELECT traceparent, count(*) AS packets FROM p GROUP BY ALL")
def header_lookup(spark, sf_dir):
    return telemetry_packets(spark, sf_dir).groupBy("traceparent").agg(F.count("*").alias("packets"))


@query(
    "player_telemetry",
    sql.PACKETS
    + """
SELECT ts AS "timestamp", session_uid, CAST(session_time AS DOUBLE) AS session_time,
       speed, rpm, traceparent FROM t
""",
)
def player_telemetry(spark, sf_dir):
    return plain(telemetry_rows(spark, sf_dir))


@query(
    "lap_rows",
    sql.PACKETS
    + f"""
SELECT ts AS "timestamp", session_uid, CAST(session_time AS DOUBLE) AS session_time, car_index,
       {", ".join(sql.LAP_FIELDS)}, traceparent FROM l
""",
)
def lap_rows_query(spark, sf_dir):
    return plain(lap_rows(spark, sf_dir))


_TRACE = (
    "'00-' || md5(CAST({0} AS VARCHAR)) || '-' "
    "|| substr(md5('s' || CAST({0} AS VARCHAR)), 1, 16) || '-01'"
)

PARTICIPANTS_SQL = """
SELECT make_timestamp(p_partkey * 1000000) AS "timestamp", CAST(p_size AS BIGINT) AS session_uid,
       CAST(CAST(p_partkey / 2 AS FLOAT) AS DOUBLE) AS session_time, CAST(p_partkey % 24 AS INT) AS car_index,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN (CAST(p_partkey % 24 AS INT)) % 2 END AS ai_controlled,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN p_size END AS driver_id,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN p_size + CAST(p_partkey % 24 AS INT) END AS team_id,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN CAST(p_partkey % 24 AS INT) + 1 END AS race_number,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN 7 END AS nationality,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN p_name || ' é' END AS name,
       CASE WHEN CAST(p_partkey % 24 AS INT) < 22 THEN 3 END AS platform
"""

LOBBY_SQL = """
SELECT make_timestamp(c_custkey * 1000000) AS "timestamp", CAST(c_nationkey AS BIGINT) AS session_uid,
       CAST(CAST(c_custkey / 2 AS FLOAT) AS DOUBLE) AS session_time, CAST(c_custkey % 24 AS INT) AS car_index,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN 0 END AS ai_controlled,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN c_nationkey + CAST(c_custkey % 24 AS INT) END AS team_id,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN c_nationkey END AS nationality,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN c_name END AS name,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN CAST(c_custkey % 24 AS INT) + 1 END AS car_number,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN 1 END AS platform,
       CASE WHEN CAST(c_custkey % 24 AS INT) < 22 THEN (CAST(c_custkey % 24 AS INT)) % 3 END AS ready_status
"""


@query("participant_rows", f"{PARTICIPANTS_SQL}, {_TRACE.format('p_partkey')} AS traceparent FROM part")
def participant_rows(spark, sf_dir):
    records = feeds.participant_records(spark, sf_dir)
    return plain(project.participant_rows(envelope.read_packets(records, schemas.PARTICIPANTS_JSON)))


@query("lobby_rows", f"{LOBBY_SQL}, {_TRACE.format('c_custkey')} AS traceparent FROM customer")
def lobby_rows(spark, sf_dir):
    records = feeds.lobby_records(spark, sf_dir)
    return plain(project.lobby_rows(envelope.read_packets(records, schemas.LOBBY_JSON)))


@query(
    "name_decode",
    """
SELECT p_partkey, p_name AS name,
       '[' || array_to_string(list_transform(range(1, length(p_name) + 1),
              lambda i: ascii(substr(p_name, i, 1))), ', ') || ']' AS name_raw
FROM part
""",
)
def name_decode(spark, sf_dir):
    codes = F.transform(F.split("p_name", ""), F.ascii)
    rows = feeds.table(spark, sf_dir, "part").select("p_partkey", codes.alias("codes"))
    return rows.select(
        "p_partkey",
        packet_columns.name_text(F.col("codes")).alias("name"),
        packet_columns.name_raw(F.col("codes")).alias("name_raw"),
    )


@query(
    "player_index",
    """
SELECT vec_id, CAST(embedding[label + 1] AS DOUBLE) AS inside,
       CAST(embedding[vec_id + 1] AS DOUBLE) AS by_row
FROM embeddings
""",
)
def player_index(spark, sf_dir):
    """An index from the row into its array; row numbers soon run past the end."""
    rows = feeds.table(spark, sf_dir, "embeddings")
    vector = F.col("embedding")
    return plain(
        rows.select(
            "vec_id",
            packet_columns.element(vector, F.col("label")).alias("inside"),
            packet_columns.element(vector, F.col("vec_id").cast("int")).alias("by_row"),
        )
    )


@query(
    "split_time_ms",
    """
SELECT l_orderkey, l_linenumber,
       CAST(l_linenumber AS BIGINT) * 60000 + CAST(l_quantity AS INT) AS split_ms
FROM lineitem
""",
)
def split_time_ms(spark, sf_dir):
    split = packet_columns.split_ms(F.col("l_linenumber"), F.col("l_quantity").cast("int"))
    return feeds.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", split.alias("split_ms")
    )


# --- feeds --------------------------------------------------------------------------

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.000Z')"


def _json_field(name: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '' ELSE ',\"{name}\":' || CAST({value} AS VARCHAR) END"


@query(
    "feed_records",
    sql.PACKETS
    + f""", w AS ({sql.telemetry_windows(3600, ["speed"]).replace(
        "CAST(max(session_time) AS DOUBLE)", "max(session_time)")})
SELECT CAST(session_uid AS VARCHAR) AS key,
       '{{"window_start":"' || {_ISO.format("window_start")} || '","window_end":"'
       || {_ISO.format("window_end")} || '"' || """
    + " || ".join(
        _json_field(c, c)
        for c in ("session_uid", "session_time", "avg_speed", "min_speed", "max_speed", "sample_count")
    )
    + " || '}' AS value FROM w",
)
def feed_records(spark, sf_dir):
    return envelope.feed_records(windows.speed_windows(telemetry_rows(spark, sf_dir), "1 hour"))


def _aggregate_feed(spark, sf_dir, measure):
    return feeds.aggregate_records(feeds.events(spark, sf_dir), measure)


_VALID = """
SELECT strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS window_start,
       strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS window_end,
       user_id AS session_uid, CAST(k + 0.5 AS DOUBLE) AS session_time, floor(value) + 0.25 AS avg_{0},
       k AS min_{0}, CAST(floor(value) AS INT) AS max_{0}, event_id AS sample_count
FROM e WHERE event_type = 'click'
"""


@query("feed_valid_speed", sql.PACKETS + _VALID.format("speed"))
def feed_valid_speed(spark, sf_dir):
    return plain(envelope.valid_feed(_aggregate_feed(spark, sf_dir, "speed"), "speed"))


@query("feed_valid_rpm", sql.PACKETS + _VALID.format("rpm"))
def feed_valid_rpm(spark, sf_dir):
    return plain(envelope.valid_feed(_aggregate_feed(spark, sf_dir, "rpm"), "rpm"))


@query("feed_rejects", "SELECT event_id FROM events WHERE event_type <> 'click'")
def feed_rejects(spark, sf_dir):
    return envelope.reject_feed(_aggregate_feed(spark, sf_dir, "speed"), "speed").select("event_id")


_MESSAGE = (
    "'{{\"type\":\"{0}\",\"data\":{{\"window_start\":\"' || window_start || '\",\"window_end\":\"' "
    "|| window_end || '\",\"session_uid\":' || session_uid || ',\"session_time\":' || CAST(session_time AS FLOAT) "
    "|| ',\"avg_{0}\":' || avg_{0} || ',\"min_{0}\":' || min_{0} || ',\"max_{0}\":' || max_{0} "
    "|| ',\"sample_count\":' || sample_count || '}}}}'"
)


@query(
    "feed_merge",
    sql.PACKETS
    + f", s AS ({_VALID.format('speed')}), r AS ({_VALID.format('rpm')}) "
    + f"SELECT 'speed' AS type, {_MESSAGE.format('speed')} AS message FROM s UNION ALL "
    + f"SELECT 'rpm' AS type, {_MESSAGE.format('rpm')} AS message FROM r",
)
def feed_merge(spark, sf_dir):
    return envelope.merge_feeds(
        _aggregate_feed(spark, sf_dir, "speed"), _aggregate_feed(spark, sf_dir, "rpm")
    )


@query("feed_dispatch", sql.PACKETS + _VALID.format("rpm"))
def feed_dispatch(spark, sf_dir):
    return plain(envelope.dispatch(feed_merge(spark, sf_dir), "rpm"))


# --- lineage ------------------------------------------------------------------------


@query(
    "trace_parse",
    """
SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id
FROM events WHERE event_type NOT IN ('view', 'error', 'signup')
""",
)
def trace_parse(spark, sf_dir):
    """Views have two parts, errors five, sign-ups none; clicks end in spare dashes."""
    kind, sound = F.col("event_type"), feeds.trace_parent(F.col("event_id"))
    parent = (
        F.when(kind == "view", F.lit("00-bad"))
        .when(kind == "error", F.concat(sound, F.lit("-x")))
        .when(kind == "click", F.concat(sound, F.lit("--")))
        .when(kind == "purchase", sound)
    )
    rows = feeds.table(spark, sf_dir, "events").select("event_id", parent.alias("traceparent"))
    return lineage.with_trace_ids(lineage.known_traces(rows), "quarantine")


@query(
    "trace_quarantine",
    """
SELECT event_id, CASE WHEN event_type = 'view' THEN '00-bad' ELSE 'a-b-c-d-e' END AS traceparent
FROM events WHERE event_type IN ('view', 'error')
""",
)
def trace_quarantine(spark, sf_dir):
    kind = F.col("event_type")
    parent = (
        F.when(kind == "view", F.lit("00-bad"))
        .when(kind == "error", F.lit("a-b-c-d-e"))
        .when(kind == "click", feeds.trace_parent(F.col("event_id")))
    )
    rows = feeds.table(spark, sf_dir, "events").select("event_id", parent.alias("traceparent"))
    return lineage.bad_traces(rows)


@query(
    "distinct_traces",
    "SELECT DISTINCT '00-' || md5(CAST(user_id AS VARCHAR)) || '-' "
    "|| substr(md5('s' || CAST(user_id AS VARCHAR)), 1, 16) || '-01' AS traceparent FROM events",
)
def distinct_traces(spark, sf_dir):
    """Events of one user share a trace here, so copies abound."""
    rows = feeds.table(spark, sf_dir, "events")
    return lineage.distinct_traces(rows.select(feeds.trace_parent(F.col("user_id")).alias("traceparent")))


@query(
    "packet_spans",
    """
SELECT 'participants-write' AS span_name, md5(CAST(p_partkey AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(p_partkey AS VARCHAR)), 1, 16) AS span_id,
       'participants-write_complete' AS event
FROM part
""",
)
def packet_spans(spark, sf_dir):
    records = feeds.participant_records(spark, sf_dir)
    rows = project.participant_rows(envelope.read_packets(records, schemas.PARTICIPANTS_JSON))
    return lineage.packet_spans(rows, lineage.PARTICIPANTS_SPAN)


_LINKED = sql.PACKETS + f", w AS (SELECT {sql.window_columns(86400)}, * FROM t)"


@query(
    "window_lineage",
    _LINKED
    + """, c AS (SELECT window_start, window_end, session_uid, count(*) AS sample_count
                 FROM w GROUP BY ALL)
SELECT 'speed-aggregation-window' AS span_name, c.window_start, c.window_end, c.session_uid,
       c.sample_count, md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id
FROM w JOIN c ON w.window_start = c.window_start AND w.session_uid IS NOT DISTINCT FROM c.session_uid
WHERE traceparent IS NOT NULL
""",
)
def window_lineage(spark, sf_dir):
    partials = windows.trace_windows(telemetry_rows(spark, sf_dir), [], "1 day")
    stored = scratch.saved(partials, "trace-windows")  # read by both sides of the join
    return plain(lineage.window_lineage(stored, lineage.SPEED_SPAN))


@query(
    "window_spans",
    _LINKED
    + """
SELECT 'rpm-aggregation-window' AS span_name, window_start, window_end, session_uid,
       count(*) AS sample_count, count(DISTINCT traceparent) AS link_count,
       'rpm-aggregation-window_complete' AS event
FROM w GROUP BY ALL HAVING count(DISTINCT traceparent) > 0
""",
)
def window_spans(spark, sf_dir):
    partials = windows.trace_windows(telemetry_rows(spark, sf_dir), ["rpm"], "1 day")
    merged = windows.merge_trace_windows(partials, ["rpm"])
    return plain(lineage.window_spans(merged, lineage.RPM_SPAN))


@query(
    "window_links",
    _LINKED
    + """
SELECT 'rpm-aggregation-window' AS span_name, window_start, window_end, session_uid,
       md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id
FROM w WHERE traceparent IS NOT NULL
""",
)
def window_links(spark, sf_dir):
    links = lineage.window_links(telemetry_rows(spark, sf_dir), "1 day")
    return plain(lineage.span_links(links, lineage.RPM_SPAN))


@query(
    "window_trace_sets",
    _LINKED
    + """
SELECT DISTINCT window_start, window_end, session_uid, traceparent FROM w WHERE traceparent IS NOT NULL
""",
)
def window_trace_sets(spark, sf_dir):
    """The sets as rows, so that none outgrows one."""
    return plain(lineage.window_links(telemetry_rows(spark, sf_dir), "1 day"))


@query(
    "trace_make",
    f"SELECT event_id, {_TRACE.format('event_id')} AS traceparent FROM events",
)
def trace_make(spark, sf_dir):
    """The parent written to a record's headers and found there again."""
    rows = feeds.table(spark, sf_dir, "events")
    headers = traces.to_headers(feeds.trace_parent(F.col("event_id")))
    return rows.select("event_id", traces.from_headers(headers).alias("traceparent"))
