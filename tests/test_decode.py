import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from paddockflow.operators import decode, envelope, lineage
from paddockflow.sources import datagrams, layouts

SIZES = {
    "motion": 1349, "session": 753, "lap": 1285, "event": 49, "participants": 1284,
    "car_setups": 1133, "car_telemetry": 1352, "car_status": 1239, "final_classification": 1042,
    "lobby_info": 954, "car_damage": 1041, "session_history": 1460, "tyre_sets": 231,
    "motion_ex": 273, "time_trial": 101, "lap_positions": 1131,
}

# struct formats of the parts, written apart from the layouts: (before, repeated, times, after)
FORMATS = {
    "motion": ("", "6f6h6f", 22, ""),
    "lap": ("", "IIHBHBHBHBfff15BHHBfB", 22, "BB"),
    "participants": ("B", "7B32BBBHBB12B", 22, ""),
    "car_setups": ("", "4B4f9B4fBf", 22, "f"),
    "car_telemetry": ("", "HfffBbHBBH4H4B4BH4f4B", 22, "BBb"),
    "car_status": ("", "5BfffHHBBHBBBbfffBfffB", 22, ""),
    "final_classification": ("B", "7BId3B24B", 22, ""),
    "lobby_info": ("B", "4B32B3BHB", 22, ""),
    "car_damage": ("", "4f12B18B", 22, ""),
    "time_trial": ("", "BB4I6B", 3, ""),
    "lap_positions": ("BB", "22B", 50, ""),
    "motion_ex": ("", "61f", 1, ""),
    "tyre_sets": ("B", "7BhB", 20, "B"),
    "event": ("4B", "16B", 1, ""),
    "session_history": ("7B", "IHBHBHBB", 100, "24B"),
    "session": (
        "BbbBHBbBHH6B" + "fb" * 21 + "BBB" + "BBBbbbbB" * 64 + "BBIII14BI33B12B", "f", 2, "",
    ),
}
HEADER = "HBBBBBQfIIBB"


def wire(kind):
    before, part, times, after = FORMATS[kind]
    return "<" + HEADER + before + part * times + after


def payload(kind, seed, extra=0):
    rng = random.Random(seed)
    data = bytearray(rng.randbytes(SIZES[kind] + extra))
    data[6] = layouts.packet_id(kind)
    return bytes(data)


def flat(value):
    if value is None or isinstance(value, (int, float)):
        return [value]
    return [leaf for part in value for leaf in flat(part)]


def same(ours, expected):
    if isinstance(expected, float) and math.isnan(expected):
        return isinstance(ours, float) and math.isnan(ours)
    return ours == expected


def frame(spark, rows):
    return spark.createDataFrame(rows, "n int, payload binary")


@pytest.mark.parametrize("kind", layouts.KINDS)
def test_sizes(kind):
    assert layouts.packet_size(kind) == SIZES[kind] == struct.calcsize(wire(kind))


@pytest.mark.parametrize("kind", layouts.KINDS)
def test_every_field_of_random_bytes(spark, kind):
    raw = [payload(kind, seed, extra=seed % 3) for seed in range(6)]
    rows = decode.decode_kind(frame(spark, list(enumerate(raw))), kind, keep=["n"]).collect()
    assert len(rows) == 6
    for row in rows:
        expected = list(struct.unpack(wire(kind), raw[row["n"]][: SIZES[kind]]))
        uid = expected[6]
        expected[6] = uid - 2**64 if uid >= 2**63 else uid
        ours = flat([row[c] for c in row.__fields__ if c not in ("n", "packet_id", "packet_kind")])
        assert len(ours) == len(expected)
        assert all(same(a, b) for a, b in zip(ours, expected))


def test_routing_and_guard(spark):
    whole = payload("lap", 1)
    rows = frame(
        spark,
        [(1, whole), (2, whole[:-1]), (3, whole + b"more"), (4, b"abc"),
         (5, b"\0" * 6 + b"\xc8" + b"\0" * 2000), (6, b"")],
    )
    got = {r["n"]: (r["packet_kind"], r["datagram_status"]) for r in decode.route(rows).collect()}
    assert got == {
        1: ("lap", "ok"), 2: ("lap", "short"), 3: ("lap", "ok"), 4: ("motion", "short"),
        5: (None, "unknown"), 6: ("motion", "short"),
    }
    assert {r["n"] for r in decode.rejects(rows).collect()} == {2, 4, 5, 6}
    assert {r["n"] for r in decode.decode(rows, ["lap"], keep=["n"]).collect()} == {1, 3}


def test_all_kinds_in_one_pass(spark):
    raw = [(i, payload(kind, i)) for i, kind in enumerate(layouts.KINDS)]
    rows = decode.decode(frame(spark, raw), keep=["n"]).collect()
    for row in rows:
        filled = [kind for kind in layouts.KINDS if row[kind] is not None]
        assert filled == [layouts.KINDS[row["n"]]] == [row["packet_kind"]]
    assert len(rows) == 16


def test_narrow_fields(spark):
    packets = decode.decode_kind(
        frame(spark, [(0, payload("car_telemetry", 3))]), "car_telemetry", fields=["m_header", "m_speed"]
    )
    assert packets.schema["m_car_telemetry_data"].dataType.elementType.names == ["m_speed"]
    with pytest.raises(ValueError, match="no field"):
        layouts.pick("lap", ["m_wings"])


def test_published_json_reads_back(spark):
    data = bytearray(payload("car_telemetry", 4))
    data[7:15] = struct.pack("<Q", 2**63 + 7)
    data[15:19] = struct.pack("<f", float("nan"))
    decoded = decode.decode(
        frame(spark, [(0, bytes(data))]), list(layouts.PUBLISHED), keep=["n"], nan_as_null=True
    )
    records = envelope.packet_records(decoded, list(layouts.PUBLISHED), F.lit("t"), F.lit("s"))
    row = records.select(
        "key",
        F.get_json_object("value", "$.m_header.m_session_uid").alias("uid"),
        F.get_json_object("value", "$.m_header.m_session_time").alias("time"),
        F.get_json_object("value", "$.m_suggested_gear").alias("gear"),
    ).first()
    assert row["key"] == f"session_{2**63 + 7}" and row["uid"] == str(2**63 + 7)
    assert row["time"] is None
    assert int(row["gear"]) == struct.unpack("<b", data[-1:])[0]
    seen = lineage.packet_attributes(decoded, list(layouts.PUBLISHED)).first()
    assert (seen["packet_id"], seen["session_uid"], seen["packet_type"]) == (6, -(2**63) + 7, "car_telemetry")


@pytest.mark.parametrize(
    "variant, fmt",
    [("fastest_lap", "<Bf"), ("retirement", "<BB"), ("penalty", "<7B"), ("speed_trap", "<BfBBBf"),
     ("stop_go_penalty_served", "<Bf"), ("flashback", "<If"), ("buttons", "<I"), ("collision", "<BB")],
)
def test_event_details(spark, variant, fmt):
    rng = random.Random(5)
    raw = []
    for n in range(20):
        data = bytearray(payload("event", n))
        values = [rng.choice([0.0, -1.5, 1e-40, 3e38, 0.1]) if c == "f" else None for c in fmt]
        data[33:49] = rng.randbytes(16)
        at = 33
        for code, value in zip(fmt[1:].replace("7B", "BBBBBBB"), values[1:] + [None] * 7):
            if code == "f":
                data[at:at + 4] = struct.pack("<f", value)
            at += struct.calcsize("<" + code)
        data[29:33] = b"SPTP"
        raw.append((n, bytes(data)))
    packets = decode.decode_kind(frame(spark, raw), "event", keep=["n"])
    rows = decode.event_code(decode.event_details(packets, variant)).collect()
    for row in rows:
        details = raw[row["n"]][1][33:49]
        assert tuple(row[variant]) == struct.unpack(fmt, details[: struct.calcsize(fmt)])
        assert row["event_code"] == "SPTP" and bytes(row["event_details"]) == details


def test_binary_file_source(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.bin").write_bytes(payload("time_trial", n))
    rows = datagrams.read(spark, str(tmp_path), "binaryFile")
    assert decode.decode_kind(rows, "time_trial", keep=["source", "timestamp"]).count() == 3
