"""Small hand-made records for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
RECORD = (
    "key string, value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp"
)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def trace(n: int) -> str:
    return f"00-{n:032x}-{n:016x}-01"


def header(uid=7, time=1.5, frame=1, player=0):
    return {
        "m_session_uid": uid, "m_session_time": time, "m_frame_identifier": frame,
        "m_player_car_index": player,
    }


def telemetry(speeds=(100,), rpms=None, **head):
    rpms = rpms or [10 * s for s in speeds]
    cars = [{"m_speed": s, "m_engine_rpm": r} for s, r in zip(speeds, rpms)]
    return json.dumps({"m_header": header(**head), "m_car_telemetry_data": cars})


def record(value, seconds=0.0, traceparent=None, headers=None):
    if headers is None and traceparent is not None:
        headers = [("traceparent", traceparent.encode())]
    return ("k", value.encode() if value is not None else None, headers, at(seconds))


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)
