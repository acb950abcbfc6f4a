"""Capture files, events by code, and event types that no list names."""

import io
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from checking import compare, connect
from paddockflow import scratch
from paddockflow.operators import decode
from paddockflow.plans import catalog
from paddockflow.sources import captures, layouts
from paddockflow.streaming import pipeline
from paddockflow.streaming.sinks import FeedSink

START = datetime(2025, 1, 1, tzinfo=timezone.utc)


def capture(payloads, place=0):
    out = b""
    for n, payload in enumerate(payloads):
        out += captures.frame(place + len(out), n, payload)
    return out


def ranges(data, split):
    return [f[2] for low in range(0, len(data), split) for f in captures.frames(io.BytesIO(data), low, min(len(data), low + split))]


def test_any_split_gives_every_frame_once():
    draw = random.Random(3)
    payloads = [draw.randbytes(draw.choice([0, 1, 30, 300])) for _ in range(200)] + [b"x" * captures.MAX_PAYLOAD]
    payloads[7:9] = [captures.MARKER * 20, capture([b"a frame in a frame"] * 3)]
    data = capture(payloads)
    for split in (1 << 20, 1000, 97):
        assert ranges(data, split) == payloads


def test_damage_and_cuts_cost_only_their_own_frames():
    payloads = [bytes([n]) * 40 for n in range(50)]
    data = bytearray(capture(payloads))
    size = len(data) // 50
    data[size * 10 + 30] ^= 1  # payload
    data[size * 20] ^= 1  # marker
    data[size * 30 + 17] ^= 1  # length
    kept = [p for n, p in enumerate(payloads) if n not in (10, 20, 30)]
    assert ranges(bytes(data), 77) == kept == ranges(bytes(data), 1 << 20)
    assert ranges(bytes(data[: size * 49 + 5]), 100) == kept[:-1]
    cut = bytes(data[: size * 5 + 3])
    assert captures.whole_end(io.BytesIO(cut), len(cut), 0) == size * 5
    assert captures.whole_end(io.BytesIO(b"noise" * 99), 495, 7) == 7


def datagrams(spark, count):
    rows = [(START + timedelta(seconds=n), bytes([n % 256]) * (n % 50)) for n in range(count)]
    return spark.createDataFrame(rows, "timestamp timestamp, payload binary")


def test_one_large_file_is_read_by_several_tasks(spark):
    root = scratch.new_folder(spark, "t")
    rows = datagrams(spark, 3000)
    captures.write(rows.coalesce(1), f"{root}/in")
    read = captures.read(spark, f"{root}/in", split_bytes=5000)
    assert read.rdd.getNumPartitions() > 10
    assert read.select("source").distinct().count() == 1
    assert sorted(map(tuple, read.select("timestamp", "payload").collect())) == sorted(map(tuple, rows.collect()))
    assert read.select("offset").distinct().count() == 3000
    captures.write(rows.limit(0), f"{root}/in")
    assert captures.read(spark, f"{root}/in").count() == 3000
    assert captures.read(spark, f"{root}/nothing").count() == 0
    with pytest.raises(Exception, match="only appended"):
        rows.write.format("capture").mode("overwrite").save(f"{root}/in")
    with pytest.raises(Exception, match="no datagram"):
        captures.write(spark.createDataFrame([(START, b"x" * 70_000)], rows.schema), f"{root}/in")
    assert captures.read(spark, f"{root}/in").count() == 3000


def test_a_stream_goes_on_at_its_offset(spark, tmp_path):
    """A file that grows, with a frame half written when the first run looks."""
    payloads = [bytes([n]) * 30 for n in range(9)]
    data = capture(payloads)
    size, root = len(data) // 9, scratch.new_folder(spark, "t")
    path = tmp_path / "in"
    path.mkdir()

    def run():
        seen = []
        (
            captures.read_stream(spark, str(path), split_bytes=100).writeStream
            .foreachBatch(lambda rows, _: seen.extend(bytes(r["payload"]) for r in rows.collect()))
            .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
        )
        return sorted(seen)

    (path / "a.capture").write_bytes(data[: size * 4 + 11])
    assert run() == payloads[:4]
    with (path / "a.capture").open("ab") as file:
        file.write(data[size * 4 + 11 :])
    (path / "b.capture").write_bytes(capture([b"other"]))
    (path / ".c.capture.unfinished").write_bytes(capture([b"not yet"]))
    assert run() == sorted([*payloads[4:], b"other"])
    assert run() == []


def test_captures_are_published(spark, tmp_path):
    root = scratch.new_folder(spark, "t")
    packet = np.zeros(1, layouts.packet_dtype("car_telemetry"))
    packet["m_header"]["m_packet_id"] = layouts.packet_id("car_telemetry")
    captures.write(spark.createDataFrame([(START, packet.tobytes()), (START, b"short")], "timestamp timestamp, payload binary"), f"{root}/in")
    pipeline.start_publish(
        captures.read_stream(spark, f"{root}/in"), FeedSink("parquet", {"path": f"{root}/out"}), f"{root}/cp",
        F.lit("a"), F.lit("b"), trigger={"availableNow": True},
    ).awaitTermination()
    assert [r["packet_kind"] for r in spark.read.parquet(f"{root}/out").collect()] == ["car_telemetry"]


# --- events by code -------------------------------------------------------------------------


def event(code, details):
    packet = np.zeros(1, layouts.packet_dtype("event"))
    packet["m_header"]["m_packet_id"] = layouts.packet_id("event")
    packet["m_header"]["m_session_uid"] = 1 << 63
    packet["m_event_string_code"] = np.frombuffer(code, np.uint8)
    packet["m_event_details"] = np.frombuffer(details.ljust(16, b"\0"), np.uint8)
    return packet.tobytes()


def test_each_code_reads_its_own_variant(spark):
    rows = []
    for code, variant in layouts.EVENT_CODES.items():
        values = np.zeros(1, layouts.details_dtype(variant))
        for n, name in enumerate(values.dtype.names):
            values[name] = n + 1.5 if values.dtype[name].kind == "f" else n + 1
        rows.append((code, event(code.encode(), values.tobytes())))
    rows += [("SSTA", event(b"SSTA", b"rest")), ("\xff\0A ", event(b"\xff\0A ", b"\1" * 16))]
    rows += [("short", event(b"FTLP", b"")[:-1]), ("none", None), ("other", b"\0" * 2000)]
    got = decode.event_union(spark.createDataFrame(rows, "name string, payload binary").coalesce(1), keep=["name"]).collect()
    assert [r["name"] for r in got] == [r["event_code"] for r in got] == [name for name, _ in rows[:-3]]
    for r in got:
        assert r["m_header"]["m_session_uid"] == -(1 << 63)
        own = layouts.EVENT_CODES.get(r["name"])
        assert r["variant"] == own
        if own is None:
            assert r["details"] is None and len(r["raw_details"]) == 16
            continue
        assert r["raw_details"] is None
        assert {v: d is not None for v, d in r["details"].asDict().items()} == {v: v == own for v in layouts.EVENT_CODES.values()}
        dtype = layouts.details_dtype(own)
        assert list(r["details"][own]) == [n + 1.5 if dtype[name].kind == "f" else n + 1 for n, name in enumerate(dtype.names)]
    none = spark.createDataFrame([], "name string, payload binary")
    assert decode.event_union(none).collect() == []


def test_wide_arrow_offsets(spark):
    """Decoding reads the offsets that Arrow has, whatever their width."""
    setting = "spark.sql.execution.arrow.useLargeVarTypes"
    packets = spark.createDataFrame([(n, event(b"BUTN", bytes([n]))) for n in range(5)], "n int, payload binary")
    spark.conf.set(setting, "true")
    try:
        rows = decode.decode_kind(packets, "event", keep=["n"]).collect()
        assert [(r["n"], r["m_event_details"][0]) for r in rows] == [(n, n) for n in range(5)]
        assert [r["details"]["buttons"]["button_status"] for r in decode.event_union(packets).collect()] == list(range(5))
    finally:
        spark.conf.unset(setting)


# --- event types outside every list ---------------------------------------------------------


@pytest.mark.parametrize(
    "name", ["publish_records", "packet_attributes", "first_packet_per_kind", "latest_per_type", "stream_live_history"]
)
def test_unlisted_and_missing_types(spark, tmp_path, name):
    types = ["click", "view", "purchase", "signup", "error", "reset", None]
    rows = [(n, datetime(2024, 1, 1) + timedelta(minutes=n), n % 5, types[n % 7], float(n), f'{{"k": {n % 90}}}') for n in range(70)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "made"))
    made = next((tmp_path / "made").glob("*.parquet"))
    made.rename(tmp_path / "events.parquet")
    good, message = compare(catalog.queries()[name](spark, str(tmp_path)), connect(str(tmp_path)), catalog.oracle_sql()[name])
    assert good, message
