"""Record, packet and warehouse schemas, as DDL text.

The JSON packet schemas list only what each query reads.  ``from_json`` is not
pruned through an array index, so the narrow schema is what keeps the parser from
building the 22 wide car structs it would throw away.
"""

from __future__ import annotations

# --- fixed values: names and types that the stored data must carry ---------------

RECORD = (
    "key STRING, value BINARY, "
    "headers ARRAY<STRUCT<key: STRING, value: BINARY>>, timestamp TIMESTAMP"
)

# The session id is unsigned 64-bit on the wire, so it is read as a decimal.
_HEADER = (
    "m_header STRUCT<m_session_uid: DECIMAL(20,0), m_session_time: FLOAT, "
    "m_frame_identifier: BIGINT, m_player_car_index: INT>"
)

TELEMETRY_JSON = (
    f"{_HEADER}, m_car_telemetry_data ARRAY<STRUCT<m_speed: INT, m_engine_rpm: INT>>"
)

LAP_JSON = (
    f"{_HEADER}, m_lap_data ARRAY<STRUCT<"
    "m_last_lap_time_in_ms: BIGINT, m_current_lap_time_in_ms: BIGINT, "
    "m_sector1_time_ms_part: INT, m_sector1_time_minutes_part: INT, "
    "m_sector2_time_ms_part: INT, m_sector2_time_minutes_part: INT, "
    "m_car_position: INT, m_current_lap_num: INT, m_num_pit_stops: INT, "
    "m_penalties: INT, m_total_warnings: INT, m_corner_cutting_warnings: INT, "
    "m_grid_position: INT, m_speed_trap_fastest_speed: FLOAT>>"
)

PARTICIPANTS_JSON = (
    f"{_HEADER}, m_participants ARRAY<STRUCT<"
    "m_ai_controlled: INT, m_driver_id: INT, m_team_id: INT, m_race_number: INT, "
    "m_nationality: INT, m_name: ARRAY<INT>, m_platform: INT>>"
)

LOBBY_JSON = (
    f"{_HEADER}, m_lobby_players ARRAY<STRUCT<"
    "m_ai_controlled: INT, m_team_id: INT, m_nationality: INT, m_platform: INT, "
    "m_name: ARRAY<INT>, m_car_number: INT, m_ready_status: INT>>"
)

SPEED_FEED = (
    "window_start STRING, window_end STRING, session_uid BIGINT, session_time FLOAT, "
    "avg_speed DOUBLE, min_speed INT, max_speed INT, sample_count BIGINT"
)

RPM_FEED = (
    "window_start STRING, window_end STRING, session_uid BIGINT, session_time FLOAT, "
    "avg_rpm DOUBLE, min_rpm INT, max_rpm INT, sample_count BIGINT"
)

FEEDS = {"speed": SPEED_FEED, "rpm": RPM_FEED}

WAREHOUSE = {
    "lap": (
        "window_start TIMESTAMP, window_end TIMESTAMP, session_uid BIGINT, "
        "session_time FLOAT, car_index INT, current_lap_num INT, "
        "last_lap_time_ms BIGINT, current_lap_time_ms BIGINT, sector1_time_ms BIGINT, "
        "sector2_time_ms BIGINT, car_position INT, speed_trap_fastest_speed FLOAT, "
        "num_pit_stops INT, penalties INT, total_warnings INT, "
        "corner_cutting_warnings INT, grid_position INT, sample_count BIGINT"
    ),
    "speed_aggregation": (
        "window_start TIMESTAMP, window_end TIMESTAMP, session_uid BIGINT, "
        "session_time FLOAT, avg_speed DOUBLE, min_speed INT, max_speed INT, "
        "sample_count BIGINT"
    ),
    "rpm_aggregation": (
        "window_start TIMESTAMP, window_end TIMESTAMP, session_uid BIGINT, "
        "session_time FLOAT, avg_rpm DOUBLE, min_rpm INT, max_rpm INT, "
        "sample_count BIGINT"
    ),
    "participants": (
        "timestamp TIMESTAMP, session_uid BIGINT, session_time FLOAT, car_index INT, "
        "ai_controlled INT, driver_id INT, team_id INT, race_number INT, "
        "nationality INT, name STRING, platform INT"
    ),
    "lobby_info": (
        "timestamp TIMESTAMP, session_uid BIGINT, session_time FLOAT, car_index INT, "
        "ai_controlled INT, team_id INT, nationality INT, name STRING, "
        "car_number INT, platform INT, ready_status INT"
    ),
}

# --- end of fixed values ---------------------------------------------------------


def columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of the columns of a flat schema."""
    return [tuple(column.split()) for column in ddl.split(",")]


def names(table: str) -> list[str]:
    """Columns of a warehouse table, in order."""
    return [name for name, _ in columns(WAREHOUSE[table])]
