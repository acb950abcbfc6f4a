"""Common parts of the check SQL: what the derived feeds hold, by plain arithmetic."""

from __future__ import annotations

# The packet each event stands for.  Undecodable text leaves every packet field NULL.
PACKETS = """
WITH e AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events
),
raw AS (
  SELECT *,
         (event_type = 'error' AND k < 10) AS broken,
         CASE WHEN event_type NOT IN ('view', 'purchase')
              THEN '00-' || md5(CAST(event_id AS VARCHAR)) || '-'
                   || substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) || '-01' END AS traceparent,
         CASE WHEN event_type = 'signup'
              THEN user_id + CAST('-9223372036854775808' AS BIGINT) ELSE user_id END AS uid
  FROM e
),
p AS (
  SELECT event_id, event_type, value, k, ts, broken, traceparent,
         CASE WHEN NOT broken THEN uid END AS session_uid,
         CASE WHEN NOT broken THEN CAST(value AS FLOAT) END AS session_time,
         CASE WHEN NOT broken THEN event_id END AS frame,
         CASE WHEN NOT broken THEN k // 4 END AS car_index,
         CASE WHEN NOT broken AND k < 88 THEN k // 4 END AS car
  FROM raw
),
t AS (
  SELECT *, CAST(floor(value) AS INT) + car AS speed, k * 100 + car * 10 AS rpm FROM p
),
l AS (
  SELECT *,
         CASE WHEN car IS NOT NULL THEN CAST(floor(value / 10) AS INT) END AS current_lap_num,
         CASE WHEN car IS NOT NULL THEN 60000 + event_id % 30000 END AS last_lap_time_ms,
         CAST(floor(value) AS BIGINT) * 100 + car AS current_lap_time_ms,
         CASE WHEN car IS NOT NULL
              THEN (CAST(floor(value) AS BIGINT) % 3) * 60000 + k * 600 END AS sector1_time_ms,
         (CAST(floor(value) AS BIGINT) % 2) * 60000 + k * 500 + car AS sector2_time_ms,
         car + 1 AS car_position,
         CASE WHEN car IS NOT NULL THEN CAST(300.5 + k AS DOUBLE) END AS speed_trap_fastest_speed,
         CASE WHEN car IS NOT NULL THEN k % 4 END AS num_pit_stops,
         CASE WHEN car IS NOT NULL THEN k % 7 END AS penalties,
         CASE WHEN car IS NOT NULL THEN k % 5 END AS total_warnings,
         CASE WHEN car IS NOT NULL THEN k % 3 END AS corner_cutting_warnings,
         22 - car AS grid_position
  FROM p
)
"""

# The same with the events of one ``k`` as a session, as the streaming queries have it.
SESSION_PACKETS = PACKETS.replace(
    "SELECT event_id, user_id,",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS user_id,",
)

LAP_FIELDS = (
    "current_lap_num", "last_lap_time_ms", "current_lap_time_ms", "sector1_time_ms",
    "sector2_time_ms", "car_position", "speed_trap_fastest_speed", "num_pit_stops",
    "penalties", "total_warnings", "corner_cutting_warnings", "grid_position",
)


def start_of(seconds: int, ts: str = "ts") -> str:
    """Start of the epoch-aligned window around a timestamp."""
    width = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {width}) * {width})"


def window_columns(seconds: int, ts: str = "ts") -> str:
    start = start_of(seconds, ts)
    return f"{start} AS window_start, {start} + INTERVAL {seconds} SECOND AS window_end"


def exact_avg(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)"


def telemetry_windows(seconds: int, measures=("speed", "rpm"), source: str = "t") -> str:
    """Select over PACKETS that aggregates the measures per window and session."""
    stats = ", ".join(
        f"{exact_avg(m)} AS avg_{m}, min({m}) AS min_{m}, max({m}) AS max_{m}" for m in measures
    )
    return f"""
SELECT {window_columns(seconds)}, session_uid,
       CAST(max(session_time) AS DOUBLE) AS session_time, {stats}, count(*) AS sample_count
FROM {source} GROUP BY ALL
"""


def lap_windows(seconds: int) -> str:
    maxima = ", ".join(f"max({c}) AS {c}" for c in LAP_FIELDS)
    return f"""
SELECT {window_columns(seconds)}, session_uid, car_index,
       CAST(max(session_time) AS DOUBLE) AS session_time, {maxima}, count(*) AS sample_count
FROM l GROUP BY ALL
"""


def closed_before(seconds: int, delay_seconds: int, source: str = "events") -> str:
    """Watermark after reading a table at once; windows ending by then are complete."""
    return (
        f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL {delay_seconds} SECOND FROM {source})"
    )
