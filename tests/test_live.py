"""State kept by key, replayed feeds, resolved links, counted loss and open windows."""

import json
import time

import pytest
from pyspark.sql import functions as F

from paddockflow import scratch
from paddockflow.operators import envelope, lineage, serve, windows
from paddockflow.sources import records as record_source
from paddockflow.sources import warehouse
from paddockflow.streaming import counts, live, pipeline, sinks
from rows import at, record, records, telemetry, trace

NOW = {"availableNow": True}
ROWS = "kind string, ts long, tie long, note string"


def land(spark, path, rows, schema=ROWS):
    frame = records(spark, rows) if schema is None else spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(path)


# --- live histories -------------------------------------------------------------------------


def follow(spark, root, n=3):
    rows = spark.readStream.schema(ROWS).parquet(f"{root}/in")
    pipeline.start_live(
        rows, f"{root}/wh", f"{root}/cp", "kind", ["ts", "tie"], n=n, trigger=NOW, name="live", state_partitions=2
    ).awaitTermination()
    changes = spark.read.parquet(f"{root}/wh/{pipeline.LIVE_CHANGES}")
    return changes


def view(changes):
    history = live.history_of(changes.drop(warehouse.BATCH)).collect()
    latest = live.latest_of(changes.drop(warehouse.BATCH), "kind", "ts", "tie").collect()
    return sorted(map(tuple, history), key=repr), sorted(map(tuple, latest), key=repr)


def expected(spark, rows, n=3):
    frame = spark.createDataFrame(rows, ROWS)
    history = serve.last_n(frame, "kind", ["ts", "tie"], n).drop("recency").collect()
    latest = serve.latest_per_kind(frame, "kind", "ts", "tie").collect()
    return sorted(map(tuple, history), key=repr), sorted(map(tuple, latest), key=repr)


def test_history_and_latest_over_restarts(spark):
    """Late rows, NULL kinds and times, and rows alike; the state never holds more than n a kind."""
    root = scratch.new_folder(spark, "t")
    loads = [
        [("a", t, 0, "x") for t in range(40)] + [(None, 1, 1, "n"), ("b", None, 5, "no time")],
        [("a", 38, 7, "late but new"), ("a", 2, 9, "too old"), ("b", 3, 1, "first time"), ("c", 1, 1, "same"), ("c", 1, 1, "same")],
        [("a", 99, 0, "newest"), (None, 2, 2, "n2"), ("b", None, 9, "no time either")],
    ]
    seen = []
    for load in loads:
        land(spark, f"{root}/in", load)
        seen += load
        assert view(follow(spark, root)) == expected(spark, seen)
    held = spark.read.format("statestore").option("stateVarName", "history").load(f"{root}/cp/live")
    assert max(r["count"] for r in held.groupBy("key").count().collect()) == 3


def test_batches_give_changes_only(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [("a", t, 0, "x") for t in range(1000)])
    first = follow(spark, root)
    assert first.count() == 3 + 1  # the history and its latest row, out of a thousand
    land(spark, f"{root}/in", [("a", 5, 0, "too old")])
    assert follow(spark, root).count() == 4
    land(spark, f"{root}/in", [("a", 998, 1, "in between")])
    last = follow(spark, root)
    changes = sorted((r["change"], r["ts"], r["tie"]) for r in last.collect())
    assert len(changes) == 6 and ("entered", 998, 1) in changes and ("left", 997, 0) in changes


def test_a_batch_is_cut_down_ahead_of_the_shuffle(spark):
    rows = spark.createDataFrame([("a", t % 70, t, "x") for t in range(700)] + [(None, 1, 1, "n")], ROWS).coalesce(1)
    cut = live.newest_of_batches(rows, "kind", ["ts", "tie"], 5)
    assert cut.count() == 6
    wanted = serve.last_n(rows, "kind", ["ts", "tie"], 5).drop("recency")
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, wanted.collect()))


# --- windows of a stalled session -----------------------------------------------------------


def close_all(spark, root, idle=0.5):
    rows = record_source.stream(spark, "parquet", path=f"{root}/in")
    job = pipeline.start_closing_telemetry(
        rows, f"{root}/wh", f"{root}/cp", seconds=1, delay_seconds=1, idle_seconds=idle,
        trigger={"processingTime": "200 milliseconds"}, name="closing", state_partitions=2,
    )
    pipeline.run_until_quiet(job, idle)


def speeds(spark, root):
    rows = warehouse.read(spark, f"{root}/wh", "speed_aggregation").collect()
    return sorted((r["session_uid"], r["window_start"].second, r["sample_count"], r["avg_speed"], r["max_speed"]) for r in rows)


def test_a_stalled_session_gives_its_last_window_once(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([int(s * 10)], uid=7), s) for s in (1.0, 1.5, 2.0)], None)
    close_all(spark, root)
    assert speeds(spark, root) == [(7, 1, 2, 12.5, 15), (7, 2, 1, 20.0, 20)]
    close_all(spark, root)  # a restart without rows adds nothing
    assert len(speeds(spark, root)) == 2
    # the session goes on; another one far ahead doesn't make its rows late
    land(spark, f"{root}/in", [
        record(telemetry([5], uid=7), 3), record(telemetry([6], uid=8), 50), record(telemetry([99], uid=7), 2.5),
    ], None)
    close_all(spark, root)
    assert speeds(spark, root) == [(7, 1, 2, 12.5, 15), (7, 2, 1, 20.0, 20), (7, 3, 1, 5.0, 5), (8, 50, 1, 6.0, 6)]
    late = spark.read.parquet(f"{root}/wh/{pipeline.LATE_WINDOWS}").collect()
    assert [(r["session_uid"], r["window_start"].second, r["sample_count"], r["max_speed"]) for r in late] == [(7, 2, 1, 99)]


def test_partials_of_a_batch_keep_nulls(spark):
    rows = spark.createDataFrame(
        [(1, at(0.2), 1.0, 5, None), (1, at(0.9), 2.0, 7, 30), (None, at(0.1), None, None, None), (1, None, 1.0, 1, 1)],
        "session_uid long, timestamp timestamp, session_time float, speed int, rpm int",
    ).coalesce(1)
    got = {r["session_uid"]: r for r in live.batch_partials(rows, ["speed", "rpm"], 1).collect()}
    assert set(got) == {1, None} and got[1]["sample_count"] == 2 and got[None]["sample_count"] == 1
    assert (got[1]["sum_speed"], got[1]["count_rpm"], got[1]["max_rpm"], got[1]["session_time"]) == (12, 1, 30, 2.0)
    assert got[None]["count_speed"] == 0 and got[None]["min_speed"] is None


# --- replayed feeds -------------------------------------------------------------------------


def feed_value(second, uid=1, **more):
    start = at(second).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    fields = {
        "window_start": start, "window_end": start, "session_uid": uid, "session_time": 1.5, "avg_speed": 1.5,
        "min_speed": 1, "max_speed": 2, "sample_count": 3,
    }
    return json.dumps(fields | more)


def merge_once(spark, root):
    feeds = [record_source.stream(spark, "parquet", path=f"{root}/{m}") for m in ("speed", "rpm")]
    pipeline.start_merge_once(
        *feeds, sinks.FeedSink("parquet", {"path": f"{root}/out"}), f"{root}/cp", delay="10 seconds", trigger=NOW,
        name="once", state_partitions=2,
    ).awaitTermination()
    found = spark.read.parquet(f"{root}/out").collect()
    return sorted((m["session_uid"], m["window_start"][17:19]) for m in (json.loads(r["message"])["data"] for r in found))


def test_a_replayed_batch_is_merged_once(spark):
    root = scratch.new_folder(spark, "t")
    batch = [record(feed_value(s, uid)) for s in (1, 2) for uid in (1, 2)]
    land(spark, f"{root}/rpm", [record("{}")], None)
    land(spark, f"{root}/speed", [*batch, record(feed_value(1, 1, sample_count=9)), record("oops")], None)
    once = [(1, "01"), (1, "02"), (2, "01"), (2, "02")]
    assert merge_once(spark, root) == once
    land(spark, f"{root}/speed", batch, None)  # the same batch again, after a restart
    assert merge_once(spark, root) == once
    land(spark, f"{root}/speed", [record(feed_value(30)), record(feed_value(4, 1, window_start="soon")), *batch], None)
    assert merge_once(spark, root) == sorted([*once, (1, ""), (1, "30")])
    state = spark.read.format("statestore").load(f"{root}/cp/once")
    assert state.count() <= 1  # what the watermark has passed is forgotten


def test_merged_batches_are_deduplicated_too(spark):
    speed = records(spark, [record(feed_value(1))] * 3)
    assert envelope.messages_once(speed, records(spark, []), "1 second").count() == 1


# --- resolved links -------------------------------------------------------------------------

LINKS = "span_name string, window_start timestamp, window_end timestamp, session_uid long, trace_id string, span_id string"
PACKETS = "packet_id int, session_uid long, frame_identifier long, packet_type string, trace_id string, span_id string, timestamp timestamp"


def link(second, name):
    return ("s", at(second), at(second + 1), 7, name, name)


def packet(second, name, frame):
    return (6, 7, frame, "car_telemetry", name, name, at(second))


def test_links_meet_packets_of_their_window(spark):
    links = spark.createDataFrame([link(1, "a"), link(1, "b"), link(2, "c")], LINKS)
    packets = spark.createDataFrame([packet(1.5, "a", 11), packet(9, "b", 12), packet(2.0, "c", 13)], PACKETS)
    rows = lineage.resolved_links(links, packets, "1 second", "1 second").collect()
    assert sorted((r["trace_id"], r["frame_identifier"]) for r in rows if r["frame_identifier"]) == [("a", 11), ("c", 13)]
    assert len(rows) == 3


def test_a_stream_gives_links_without_packet_after_the_bound(spark):
    root = scratch.new_folder(spark, "t")

    def resolve():
        links = spark.readStream.schema(LINKS).parquet(f"{root}/links")
        packets = spark.readStream.schema(PACKETS).parquet(f"{root}/packets")
        pipeline.start_resolution(
            links, packets, f"{root}/wh", f"{root}/cp", width="1 second", delay="5 seconds", trigger=NOW,
            state_partitions=2,
        ).awaitTermination()
        rows = spark.read.parquet(f"{root}/wh/{pipeline.RESOLVED_LINKS}").collect()
        return sorted(((r["trace_id"], r["frame_identifier"]) for r in rows), key=repr)

    land(spark, f"{root}/links", [link(1, "a"), link(1, "gone"), link(4, "later")], LINKS)
    land(spark, f"{root}/packets", [packet(1.2, "a", 1)], PACKETS)
    assert resolve() == [("a", 1)]
    land(spark, f"{root}/packets", [packet(4.5, "later", 2), packet(30, "x", 3)], PACKETS)
    land(spark, f"{root}/links", [link(30, "y")], LINKS)
    assert resolve() == [("a", 1), ("gone", None), ("later", 2)]
    assert resolve() == [("a", 1), ("gone", None), ("later", 2)]


# --- counts and open windows ----------------------------------------------------------------


def run_telemetry(spark, root, **options):
    job = pipeline.start_telemetry(
        record_source.stream(spark, "parquet", path=f"{root}/in"), f"{root}/wh", f"{root}/cp", trigger=NOW, **options
    )
    job.awaitTermination()
    return job


def test_batches_are_counted(spark):
    root = scratch.new_folder(spark, "t")
    with counts.BatchCounts(spark, f"{root}/counts") as kept:
        land(spark, f"{root}/in", [record(telemetry([s]), s, trace(s)) for s in (1, 9)] + [record("{oops", 9)], None)
        kept.wait(str(run_telemetry(spark, root, observe=True).runId))
        land(spark, f"{root}/in", [record(telemetry([1]), s, trace(s)) for s in (2, 3, 10)], None)
        kept.wait(str(run_telemetry(spark, root, observe=True).runId))
    rows = kept.table().where("rows_in > 0").orderBy("batch_id").collect()
    assert [(r["rows_in"], r["rows_refused"], r["late_groups"]) for r in rows] == [(3, 1, 0), (3, 0, 2)]
    assert {r["query"] for r in rows} == {"telemetry"}


def test_open_windows_are_what_is_not_out(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([s], rpms=[s + 1]), s / 2) for s in range(1, 20)], None)
    run_telemetry(spark, root, with_lineage=False)
    closed = warehouse.read(spark, f"{root}/wh", "speed_aggregation")
    held = windows.open_telemetry_windows(counts.open_windows(spark, f"{root}/cp/telemetry"))
    both = closed.unionByName(held.select(*closed.columns)).orderBy("window_start").collect()
    assert held.count() == 2 and [r["sample_count"] for r in both] == [1] + [2] * 9
    assert [r["max_speed"] for r in both] == [1, *range(3, 20, 2)]


def test_a_query_keeps_its_own_settings(spark):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [("a", 1, 1, "x")])
    follow(spark, root)
    assert spark.conf.get(setting, None) == before


def test_a_timed_job_stops_after_its_first_rows(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [("a", 1, 1, "x")])
    rows = spark.readStream.schema(ROWS).parquet(f"{root}/in")
    began = time.time()
    job = pipeline.start_live(rows, f"{root}/wh", f"{root}/cp", "kind", ["ts", "tie"], trigger=pipeline.DIMENSION_TRIGGER)
    pipeline.run_until_read(job)
    assert time.time() - began < 25 and not job.isActive
    assert spark.read.parquet(f"{root}/wh/{pipeline.LIVE_CHANGES}").count() == 2
    with pytest.raises(Exception, match="boom"):
        broken = rows.select("*", F.raise_error(F.lit("boom")).cast("string").alias("z"))
        pipeline.run_until_read(pipeline.start_live(broken, f"{root}/w2", f"{root}/c2", "kind", ["ts", "tie"]))


