"""Datagram queries: one per packet kind, over datagrams made from the events.

Body value number ``j`` of event ``n`` is ``(n + j) % 100`` (see ``feeds.datagrams``),
so the check SQL states for each field the number it must be found at.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from paddockflow import schemas
from paddockflow.functions import traces
from paddockflow.operators import decode, envelope, lineage, project, serve, windows
from paddockflow.plans import feeds, sql
from paddockflow.plans.batch import ORACLES, QUERIES, plain, query
from paddockflow.sources import layouts

# kind -> output column -> (expression on the packet, value number, type).
# ``p`` is the player's car; beyond the 22 cars the value is NULL.
FIELDS = {
    "motion": {
        "world_x": ("get(m_car_motion_data, p).m_world_position_x", "p*18", "DOUBLE"),
        "right_dir_z": ("get(m_car_motion_data, p).m_world_right_dir_z", "p*18+11", "INT"),
        "roll": ("get(m_car_motion_data, p).m_roll", "p*18+17", "DOUBLE"),
    },
    "session": {
        "track_length": ("m_track_length", "4", "INT"),
        "last_rain": ("m_weather_forecast_samples[63].m_rain_percentage", "572", "INT"),
        "sector3_start": ("m_sector3_lap_distance_start", "639", "DOUBLE"),
    },
    "lap": {
        "last_lap_ms": ("get(m_lap_data, p).m_last_lap_time_in_ms", "p*33", "BIGINT"),
        "position": ("get(m_lap_data, p).m_car_position", "p*33+13", "INT"),
        "trap_speed": ("get(m_lap_data, p).m_speed_trap_fastest_speed", "p*33+31", "DOUBLE"),
        "pb_car": ("m_time_trial_pb_car_idx", "726", "INT"),
    },
    "participants": {
        "active_cars": ("m_num_active_cars", "0", "INT"),
        "race_number": ("get(m_participants, p).m_race_number", "p*56+6", "INT"),
        "tech_level": ("get(m_participants, p).m_tech_level", "p*56+42", "INT"),
        "last_blue": ("get(m_participants, p).m_livery_colours[3].blue", "p*56+56", "INT"),
    },
    "car_setups": {
        "ballast": ("get(m_car_setup_data, p).m_ballast", "p*23+21", "INT"),
        "fuel_load": ("get(m_car_setup_data, p).m_fuel_load", "p*23+22", "DOUBLE"),
        "next_wing": ("m_next_front_wing_value", "506", "DOUBLE"),
    },
    "car_telemetry": {
        "speed": ("get(m_car_telemetry_data, p).m_speed", "p*31", "INT"),
        "rpm": ("get(m_car_telemetry_data, p).m_engine_rpm", "p*31+6", "INT"),
        "last_pressure": ("get(m_car_telemetry_data, p).m_tyres_pressure[3]", "p*31+26", "DOUBLE"),
        "gear_hint": ("m_suggested_gear", "684", "INT"),
    },
    "car_status": {
        "max_rpm": ("get(m_car_status_data, p).m_max_rpm", "p*25+8", "INT"),
        "flags": ("get(m_car_status_data, p).m_vehicle_fia_flags", "p*25+16", "INT"),
        "ers_store": ("get(m_car_status_data, p).m_ers_store_energy", "p*25+19", "DOUBLE"),
    },
    "final_classification": {
        "cars": ("m_num_cars", "0", "INT"),
        "race_time": ("get(m_classification_data, p).m_total_race_time", "p*36+9", "DOUBLE"),
        "last_stint_end": ("get(m_classification_data, p).m_tyre_stints_end_laps[7]", "p*36+36", "INT"),
    },
    "lobby_info": {
        "last_name_code": ("get(m_lobby_players, p).m_name[31]", "p*41+36", "INT"),
        "tech_level": ("get(m_lobby_players, p).m_tech_level", "p*41+40", "INT"),
        "ready_status": ("get(m_lobby_players, p).m_ready_status", "p*41+41", "INT"),
    },
    "car_damage": {
        "third_wear": ("get(m_car_damage_data, p).m_tyres_wear[2]", "p*34+2", "DOUBLE"),
        "front_left_wing": ("get(m_car_damage_data, p).m_front_left_wing_damage", "p*34+16", "INT"),
        "seized": ("get(m_car_damage_data, p).m_engine_seized", "p*34+33", "INT"),
    },
    "session_history": {
        "best_lap": ("m_best_lap_time_lap_num", "3", "INT"),
        "last_flags": ("m_lap_history_data[99].m_lap_valid_bit_flags", "806", "INT"),
        "last_compound": ("m_tyre_stints_history_data[7].m_tyre_visual_compound", "830", "INT"),
    },
    "tyre_sets": {
        "car": ("m_car_idx", "0", "INT"),
        "last_delta": ("m_tyre_set_data[19].m_lap_delta_time", "179", "INT"),
        "fitted": ("m_fitted_idx", "181", "INT"),
    },
    "motion_ex": {
        "third_wheel_speed": ("m_wheel_speed[2]", "14", "DOUBLE"),
        "pitch": ("m_chassis_pitch", "52", "DOUBLE"),
        "last_gain": ("m_wheel_camber_gain[3]", "60", "DOUBLE"),
    },
    "time_trial": {
        "team": ("m_player_session_best_data_set.m_team_id", "1", "INT"),
        "pb_lap": ("m_personal_best_data_set.m_lap_time_in_ms", "14", "BIGINT"),
        "rival_valid": ("m_rival_data_set.m_valid", "35", "INT"),
    },
    "lap_positions": {
        "lap_start": ("m_lap_start", "1", "INT"),
        "own_fourth_lap": ("get(m_position_for_vehicle_idx[3], p)", "p+68", "INT"),
        "last_slot": ("m_position_for_vehicle_idx[49][21]", "1101", "INT"),
    },
}

_EVENTS = """
WITH e AS (
  SELECT event_id, event_type, ts, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CASE WHEN event_type = 'signup'
              THEN user_id + CAST('-9223372036854775808' AS BIGINT) ELSE user_id END AS session_uid
  FROM events
),
d AS (SELECT *, k // 4 AS car, CASE WHEN k < 88 THEN k // 4 END AS p FROM e)
"""


def _datagrams(spark, sf_dir, kind):
    return feeds.datagrams(feeds.events(spark, sf_dir), kind)


def _wire_names(expressions) -> list[str]:
    """Packet fields that the expressions read, innermost ones for car structs."""
    names = {"m_header"}
    for text in expressions:
        found = re.findall(r"m_\w+", text)
        names.add(found[1] if len(found) > 1 else found[0])
    return sorted(names)


def _decode_query(kind):
    columns = FIELDS[kind]

    def run(spark, sf_dir):
        narrow = _wire_names(text for text, _, _ in columns.values())
        packets = decode.decode_kind(_datagrams(spark, sf_dir, kind), kind, fields=narrow, keep=["event_id"])
        rows = packets.withColumn("p", F.col("m_header.m_player_car_index"))
        return plain(
            rows.select(
                "event_id",
                F.col("m_header.m_session_uid").alias("session_uid"),
                *[F.expr(text).alias(name) for name, (text, _, _) in columns.items()],
            )
        )

    values = ", ".join(
        f"CAST((event_id + {at}) % 100 AS {kind_of}){' / 4' if kind_of == 'DOUBLE' else ''} AS {name}"
        for name, (_, at, kind_of) in columns.items()
    )
    return run, f"{_EVENTS} SELECT event_id, session_uid, {values} FROM d"


for _kind in FIELDS:
    QUERIES[f"decode_{_kind}"], ORACLES[f"decode_{_kind}"] = _decode_query(_kind)


@query(
    "decode_header",
    _EVENTS
    + """
SELECT event_id, 2025 AS packet_format, 6 AS packet_id, session_uid,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS session_time, event_id AS frame,
       event_id + 1 AS overall_frame, car AS player_car
FROM d
""",
)
def decode_header(spark, sf_dir):
    packets = decode.decode_kind(
        _datagrams(spark, sf_dir, "car_telemetry"), "car_telemetry", fields=["m_header"], keep=["event_id"]
    )
    header = F.col("m_header")
    return plain(
        packets.select(
            "event_id",
            header["m_packet_format"].alias("packet_format"),
            "packet_id",
            header["m_session_uid"].alias("session_uid"),
            header["m_session_time"].alias("session_time"),
            header["m_frame_identifier"].alias("frame"),
            header["m_overall_frame_identifier"].alias("overall_frame"),
            header["m_player_car_index"].alias("player_car"),
        )
    )


@query(
    "decode_event",
    _EVENTS
    + """
SELECT event_id, session_uid, CAST(event_id % 100 AS INT) AS first_code,
       CAST((event_id + 9) % 100 AS INT) AS lap_num,
       (event_id + 4) % 100 + (event_id + 5) % 100 * 256 + (event_id + 6) % 100 * 65536
         + (event_id + 7) % 100 * 16777216 AS button_status
FROM d
""",
)
def decode_event(spark, sf_dir):
    packets = decode.decode_kind(_datagrams(spark, sf_dir, "event"), "event", keep=["event_id"])
    rows = decode.event_details(decode.event_details(packets, "penalty"), "buttons")
    return rows.select(
        "event_id",
        F.col("m_header.m_session_uid").alias("session_uid"),
        F.get("m_event_string_code", F.lit(0)).alias("first_code"),
        F.col("penalty.lap_num").alias("lap_num"),
        F.col("buttons.button_status").alias("button_status"),
    )


#: Events take the codes in turn; the last two name no variant.
_CODES = [*layouts.EVENT_CODES, "SSTA", "????"]


def _coded(spark, sf_dir):
    """Event datagrams with a code each."""
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("event_id") % len(_CODES) + 1).cast("int"))
    at = layouts.packet_dtype("event").fields["m_event_string_code"][1] + 1
    payload = F.overlay(F.col("payload"), F.encode(code, "UTF-8"), F.lit(at), F.lit(4))
    return _datagrams(spark, sf_dir, "event").withColumn("payload", payload)


def _detail_sql(variant: str, field: str) -> str:
    """A field of the detail bytes by arithmetic; byte ``i`` of them is value number ``4 + i``."""
    dtype = layouts.details_dtype(variant)
    start, kind = dtype.fields[field][1], dtype[field]
    b = [f"CAST((event_id + {4 + start + i}) % 100 AS BIGINT)" for i in range(kind.itemsize)]
    if kind.kind != "f":
        return f"CAST({' + '.join(f'{x} * {1 << 8 * i}' for i, x in enumerate(b))} AS DOUBLE)"
    fraction = f"({b[0]} + {b[1]} * 256 + {b[2]} % 128 * 65536) / 8388608.0::DOUBLE"
    exponent = f"({b[3]} * 2 + {b[2]} // 128)"
    return (
        f"CASE WHEN {exponent} = 0 THEN {fraction} * pow(2.0::DOUBLE, -126) "
        f"ELSE (1 + {fraction}) * pow(2.0::DOUBLE, {exponent} - 127) END"
    )


def _union_sql() -> str:
    selects = []
    for n, (code, variant) in enumerate(layouts.EVENT_CODES.items()):
        for field in layouts.details_dtype(variant).names:
            selects.append(
                f"SELECT event_id, session_uid, '{code}' AS event_code, '{variant}.{field}' AS field, "
                f"{_detail_sql(variant, field)} AS value, NULL AS raw FROM d WHERE event_id % {len(_CODES)} = {n}"
            )
    hexed = " || ".join(f"printf('%02X', (event_id + {4 + i}) % 100)" for i in range(16))
    for n in (len(_CODES) - 2, len(_CODES) - 1):
        selects.append(
            f"SELECT event_id, session_uid, '{_CODES[n]}' AS event_code, NULL AS field, NULL AS value, "
            f"{hexed} AS raw FROM d WHERE event_id % {len(_CODES)} = {n}"
        )
    return " UNION ALL ".join(selects)


@query("decode_event_union", _EVENTS + _union_sql())
def decode_event_union(spark, sf_dir):
    """All events, each as the variant its code names, one row a field; other codes keep their bytes."""
    rows = decode.event_union(_coded(spark, sf_dir), keep=["event_id"])

    def fields(variant: str):
        of = F.col(f"details.{variant}")
        entries = [
            F.struct(F.lit(f"{variant}.{f}").alias("field"), of[f].cast("double").alias("value"))
            for f in layouts.details_dtype(variant).names
        ]
        return F.when(F.col("variant") == variant, F.array(*entries))

    return rows.select(
        "event_id", F.col("m_header.m_session_uid").alias("session_uid"), "event_code",
        F.hex("raw_details").alias("raw"),
        F.inline_outer(F.coalesce(*[fields(v) for v in layouts.EVENT_CODES.values()])),
    )


def _mixed(spark, sf_dir):
    """Sound, cut, overlong, tiny and unknown datagrams, by event type."""
    kind = F.col("event_type")
    payload = F.col("payload")
    changed = (
        F.when(kind == "view", F.substring(payload, 1, layouts.packet_size("car_telemetry") - 1))
        .when(kind == "purchase", F.concat(payload, F.unhex(F.lit("0102030405"))))
        .when(kind == "error", F.concat(F.substring(payload, 1, 6), F.unhex(F.lit("C8")), F.substring(payload, 8, 2000)))
        .when(kind == "signup", F.substring(payload, 1, 3))
        .otherwise(payload)
    )
    return _datagrams(spark, sf_dir, "car_telemetry").withColumn("payload", changed)


@query(
    "datagram_routing",
    """
SELECT CASE event_type WHEN 'error' THEN 200 WHEN 'signup' THEN 0 ELSE 6 END AS packet_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'motion' ELSE 'car_telemetry' END
         AS packet_kind,
       CASE WHEN event_type = 'error' THEN 'unknown' WHEN event_type IN ('view', 'signup') THEN 'short'
            ELSE 'ok' END AS datagram_status,
       count(*) AS datagrams
FROM events GROUP BY ALL
""",
)
def datagram_routing(spark, sf_dir):
    routed = decode.route(_mixed(spark, sf_dir))
    return routed.groupBy("packet_id", "packet_kind", "datagram_status").agg(
        F.count("*").alias("datagrams")
    )


@query(
    "datagram_rejects",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE 'short' END AS datagram_status
FROM events WHERE event_type IN ('error', 'view', 'signup')
""",
)
def datagram_rejects(spark, sf_dir):
    return decode.rejects(_mixed(spark, sf_dir)).select("event_id", "datagram_status")


@query(
    "datagram_guard",
    _EVENTS
    + """SELECT event_id, CAST((event_id + p * 31) % 100 AS INT) AS speed FROM d
         WHERE event_type IN ('click', 'purchase')""",
)
def datagram_guard(spark, sf_dir):
    """Only whole datagrams of the kind come through, those with bytes to spare too."""
    packets = decode.decode_kind(
        _mixed(spark, sf_dir), "car_telemetry", fields=["m_header", "m_speed"], keep=["event_id"]
    )
    speed = F.get("m_car_telemetry_data", F.col("m_header.m_player_car_index"))["m_speed"]
    return packets.select("event_id", speed.alias("speed"))


#: Event type -> kind; every other type, and none, is of a kind that stops after decoding.
_KINDS = {"click": "car_telemetry", "view": "lap", "purchase": "lobby_info", "signup": "participants"}
_UNPUBLISHED = "motion_ex"


def _published_kinds(spark, sf_dir):
    """All events as datagrams of four published kinds and one that is not, in one scan."""
    kind = F.lit(_UNPUBLISHED)
    for event, name in _KINDS.items():
        kind = F.when(F.col("event_type") == event, name).otherwise(kind)
    return feeds.datagrams_by_kind(feeds.events(spark, sf_dir), kind, [*_KINDS.values(), _UNPUBLISHED])


_KIND_OF = """CASE event_type WHEN 'click' THEN 'car_telemetry' WHEN 'view' THEN 'lap'
              WHEN 'purchase' THEN 'lobby_info' WHEN 'signup' THEN 'participants' END"""


@query(
    "publish_records",
    _EVENTS
    + f"""
SELECT {_KIND_OF} AS packet_kind,
       'session_' || CASE WHEN session_uid < 0
                          THEN CAST(CAST(session_uid AS HUGEINT) + 18446744073709551616 AS VARCHAR)
                          ELSE CAST(session_uid AS VARCHAR) END AS key,
       CASE WHEN session_uid < 0 THEN CAST(CAST(session_uid AS HUGEINT) + 18446744073709551616 AS VARCHAR)
            ELSE CAST(session_uid AS VARCHAR) END AS uid_text,
       event_id AS frame, '00-' || md5(CAST(event_id AS VARCHAR)) || '-'
         || substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) || '-01' AS traceparent,
       CASE event_type
         WHEN 'click' THEN (event_id + 21 * 31) % 100
         WHEN 'view' THEN (event_id + 21 * 33 + 13) % 100
         WHEN 'purchase' THEN (event_id + 21 * 41 + 41) % 100
         ELSE (event_id + 21 * 56 + 6) % 100 END AS last_car_value
FROM d WHERE event_type IN ('click', 'view', 'purchase', 'signup')
""",
)
def publish_records(spark, sf_dir):
    """Datagrams of all sorts to keyed JSON, and values read back out of the text."""
    kinds = list(layouts.PUBLISHED)
    decoded = decode.decode(_published_kinds(spark, sf_dir), kinds, keep=["event_id"], nan_as_null=True)
    number = F.col("event_id").cast("string")
    span = F.substring(F.md5(F.concat(F.lit("s"), number)), 1, 16)
    records = envelope.packet_records(decoded, kinds, F.md5(number), span)

    paths = {
        "car_telemetry": "$.m_car_telemetry_data[21].m_speed",
        "lap": "$.m_lap_data[21].m_car_position",
        "lobby_info": "$.m_lobby_players[21].m_ready_status",
        "participants": "$.m_participants[21].m_race_number",
    }
    path = F.coalesce(*[F.when(F.col("packet_kind") == kind, at) for kind, at in paths.items()])
    header = "m_header STRUCT<m_session_uid: DECIMAL(20,0), m_frame_identifier: BIGINT>"
    return records.select(
        "packet_kind", "key", "headers", "value", path.alias("path"),
        F.from_json("value", header)["m_header"].alias("header"),
    ).select(
        "packet_kind",
        "key",
        F.col("header.m_session_uid").cast("string").alias("uid_text"),
        F.col("header.m_frame_identifier").alias("frame"),
        traces.from_headers(F.col("headers")).alias("traceparent"),
        F.expr("get_json_object(value, path)").cast("bigint").alias("last_car_value"),
    )


@query(
    "packet_attributes",
    _EVENTS
    + f"""
SELECT CASE event_type WHEN 'click' THEN 6 WHEN 'view' THEN 2 WHEN 'purchase' THEN 9 ELSE 4 END
         AS packet_id,
       session_uid, event_id AS frame_identifier, {_KIND_OF} AS packet_type
FROM d WHERE event_type IN ('click', 'view', 'purchase', 'signup')
""",
)
def packet_attributes(spark, sf_dir):
    kinds = list(layouts.PUBLISHED)
    narrow = {kind: ["m_header"] for kind in kinds}
    decoded = decode.decode(_published_kinds(spark, sf_dir), kinds, fields=narrow)
    return lineage.packet_attributes(decoded, kinds)


@query(
    "first_packet_per_kind",
    _EVENTS
    + f"""
SELECT coalesce({_KIND_OF}, 'motion_ex') AS packet_kind, event_id FROM d
QUALIFY row_number() OVER (PARTITION BY packet_kind ORDER BY ts, event_id) = 1
""",
)
def first_packet_per_kind(spark, sf_dir):
    routed = decode.route(_published_kinds(spark, sf_dir))
    first = serve.first_per_kind(
        routed.select("packet_kind", "timestamp", "event_id"), "packet_kind", "timestamp", "event_id"
    )
    return first.select("packet_kind", "event_id")


@query(
    "datagram_speed_window",
    _EVENTS
    + f""", s AS (SELECT ts, session_uid, value, CAST((event_id + p * 31) % 100 AS INT) AS speed FROM d)
SELECT {sql.window_columns(3600)}, session_uid,
       CAST(max(CAST(value AS FLOAT)) AS DOUBLE) AS session_time,
       {sql.exact_avg("speed")} AS avg_speed, min(speed) AS min_speed, max(speed) AS max_speed,
       count(*) AS sample_count
FROM s GROUP BY ALL
""",
)
def datagram_speed_window(spark, sf_dir):
    """Captured datagrams straight to speed windows, with no JSON between."""
    packets = decode.decode_kind(
        _datagrams(spark, sf_dir, "car_telemetry"),
        "car_telemetry",
        fields=["m_header", "m_speed", "m_engine_rpm"],
        keep=["timestamp"],
    ).withColumn("traceparent", F.lit(None).cast("string"))
    return plain(windows.speed_windows(project.telemetry_rows(packets), "1 hour"))


@query(
    "published_speed_window",
    ORACLES["datagram_speed_window"],
)
def published_speed_window(spark, sf_dir):
    """The whole way: datagrams, JSON records, parsed packets, speed windows."""
    decoded = decode.decode(
        _datagrams(spark, sf_dir, "car_telemetry"), ["car_telemetry"],
        keep=["event_id", "timestamp"], nan_as_null=True,
    )
    number = F.col("event_id").cast("string")
    span = F.substring(F.md5(F.concat(F.lit("s"), number)), 1, 16)
    records = envelope.packet_records(decoded, ["car_telemetry"], F.md5(number), span, keep=["timestamp"])
    packets = envelope.read_packets(records, schemas.TELEMETRY_JSON)
    return plain(windows.speed_windows(project.telemetry_rows(packets), "1 hour"))
