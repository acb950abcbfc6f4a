import json

import pytest

from paddockflow import schemas, scratch
from paddockflow.operators import envelope, project, windows
from paddockflow.sources import records as record_source
from paddockflow.sources import warehouse
from paddockflow.streaming import pipeline, sinks
from rows import at, record, records, telemetry, trace

NOW = {"availableNow": True}


def land(spark, path, rows):
    records(spark, rows).coalesce(1).write.mode("append").parquet(path)


def feed(spark, path):
    return record_source.stream(spark, "parquet", path=path)


def run(spark, root, **options):
    pipeline.start_telemetry(
        feed(spark, f"{root}/in"), f"{root}/wh", f"{root}/cp", trigger=NOW, **options
    ).awaitTermination()


def speeds(spark, root):
    rows = warehouse.read(spark, f"{root}/wh", "speed_aggregation").collect()
    return sorted((r["window_start"].second, r["sample_count"], r["max_speed"]) for r in rows)


def test_windows_close_once_and_late_rows_drop(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([s]), s, trace(s)) for s in (1, 2, 3, 9)])
    run(spark, root)
    # the watermark is 8 s: windows up to 8 are out, the one at 9 is still open
    assert speeds(spark, root) == [(1, 1, 1), (2, 1, 2), (3, 1, 3)]
    run(spark, root)
    assert speeds(spark, root) == [(1, 1, 1), (2, 1, 2), (3, 1, 3)]
    land(spark, f"{root}/in", [record(telemetry([77]), 3.5), record(telemetry([88]), 9.5), record(telemetry([1]), 20)])
    run(spark, root)
    assert speeds(spark, root) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (9, 2, 88)]


def test_feeds_lineage_and_tables(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [
        record(telemetry([10]), 1.0, trace(1)), record(telemetry([30]), 1.5, trace(2)),
        record(telemetry([50]), 2.5), record(telemetry([1]), 30),
    ])
    outputs = {m: sinks.FeedSink("parquet", {"path": f"{root}/{m}"}) for m in ("speed", "rpm")}
    run(spark, root, feeds=outputs)
    values = [json.loads(r["value"]) for r in spark.read.parquet(f"{root}/rpm").collect()]
    assert sorted((v["avg_rpm"], v["sample_count"]) for v in values) == [(200.0, 2), (500.0, 1)]
    spans = spark.read.parquet(f"{root}/wh/{pipeline.WINDOW_SPANS}").where("span_name like 'speed%'").collect()
    assert [(s["span_name"], s["sample_count"], s["link_count"]) for s in spans] == [("speed-aggregation-window", 2, 2)]
    links = spark.read.parquet(f"{root}/wh/{pipeline.WINDOW_LINKS}").where("span_name like 'rpm%'").collect()
    assert sorted(int(x["trace_id"], 16) for x in links) == [1, 2]
    # what the pipeline published passes the reader's validation
    published = spark.read.parquet(f"{root}/speed").selectExpr("CAST(value AS BINARY) AS value")
    assert envelope.valid_feed(published, "speed").count() == 2


def test_bad_trace_fails_or_is_kept_out(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([1]), 1, "bad"), record(telemetry([1]), 30)])
    with pytest.raises(Exception, match="invalid traceparent"):
        run(spark, root)
    run(spark, root, on_bad_trace="quarantine")
    assert speeds(spark, root) == [(1, 1, 1)]
    assert [r["traceparent"] for r in spark.read.parquet(f"{root}/wh/{pipeline.BAD_TRACES}").collect()] == ["bad"]
    assert spark.read.schema("span_name string").parquet(f"{root}/wh/{pipeline.WINDOW_SPANS}").count() == 0


def test_failed_batch_replays_without_copies(spark):
    """The first attempt dies after its table write; the retry replaces that write."""
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([s]), s) for s in (1, 2, 30)])

    class Broken(sinks.FeedSink):
        def write(self, rows, batch):
            raise RuntimeError("feed down")

    with pytest.raises(Exception, match="feed down"):
        run(spark, root, feeds={"rpm": Broken()})  # rpm comes after the speed table
    assert speeds(spark, root) == [(1, 1, 1), (2, 1, 2)]
    run(spark, root)
    assert speeds(spark, root) == [(1, 1, 1), (2, 1, 2)]
    assert warehouse.read(spark, f"{root}/wh", "rpm_aggregation").count() == 2


def test_new_checkpoint_does_not_overwrite(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([s]), s) for s in (1, 2, 30)])
    run(spark, root)
    pipeline.start_telemetry(
        feed(spark, f"{root}/in"), f"{root}/wh", f"{root}/cp2", trigger=NOW
    ).awaitTermination()
    assert len(speeds(spark, root)) == 4


def test_all_queries_and_first_end(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([1]), 1), record("{oops", 2)])
    names = ("telemetry", "lap", "participants", "lobby_info")
    queries = pipeline.start_all({n: feed(spark, f"{root}/in") for n in names}, f"{root}/wh", f"{root}/cp")
    assert [q.name for q in queries] == ["telemetry", "lap", "participants", "lobby-info"]
    queries[0].processAllAvailable()
    queries[3].processAllAvailable()
    queries[1].stop()
    pipeline.run_until_one_ends(spark, queries)
    assert not any(q.isActive for q in queries)
    spark.streams.resetTerminated()
    rows = warehouse.read(spark, f"{root}/wh", "lobby_info").collect()
    assert [(r["session_uid"], r["name"]) for r in sorted(rows, key=str)] != []


def test_session_partition_is_pruned(spark):
    root = scratch.new_folder(spark, "t")
    rows = project.telemetry_rows(envelope.read_packets(
        records(spark, [record(telemetry([1], uid=u), 1) for u in (1, 2, 3)]), schemas.TELEMETRY_JSON))
    sinks.append_table(windows.speed_windows(rows), f"{root}/wh", "speed_aggregation", "b-1")
    one = warehouse.read(spark, f"{root}/wh", "speed_aggregation", session_uid=2)
    assert one.count() == 1
    assert all("session_uid=2/" in name for name in one.inputFiles())  # others are not even listed
    assert warehouse.read(spark, f"{root}/wh", "speed_aggregation", session_uid=99).count() == 0
    warehouse.compact(spark, f"{root}/wh", "speed_aggregation", 2, f"{root}/compact")
    assert warehouse.read(spark, f"{root}/compact", "speed_aggregation", 2).collect() == one.collect()


def test_state_is_dropped_as_windows_close(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([1]), s, trace(s)) for s in range(50)])
    query = pipeline.start_telemetry(feed(spark, f"{root}/in"), f"{root}/wh", f"{root}/cp", trigger=NOW)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_kafka_options():
    got = record_source.kafka_options("b:9092", "laps", minPartitions="64")
    assert got["subscribe"] == "laps" and got["includeHeaders"] == "true" and got["minPartitions"] == "64"


def test_tables_are_declared_once(spark):
    root = scratch.new_folder(spark, "t")
    spark.sql("CREATE DATABASE IF NOT EXISTS declared")
    for _ in range(2):
        tables = warehouse.create_tables(spark, f"{root}/wh", "declared")
    assert len(tables) == 5
    assert spark.table("declared.lap").columns[-2:] == ["session_uid", "batch"]


def test_publish_routes_kinds_to_topics(spark):
    from pyspark.sql import functions as F

    from paddockflow.sources import layouts
    from test_decode import payload

    root = scratch.new_folder(spark, "t")
    kinds = ("car_telemetry", "lap", "lobby_info", "participants", "motion")
    captured = [(n, payload(kind, n), at(n)) for n, kind in enumerate(kinds)] + [(9, b"short", at(9))]
    rows = spark.createDataFrame(captured, "n int, payload binary, timestamp timestamp")
    rows.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    number = F.col("n").cast("string")
    pipeline.start_publish(
        stream, sinks.FeedSink("parquet", {"path": f"{root}/out"}), f"{root}/cp",
        F.lpad(number, 32, "0"), F.lpad(number, 16, "0"),
        topics={kind: f"topic-{kind}" for kind in layouts.PUBLISHED}, keep=["timestamp"], trigger=NOW,
    ).awaitTermination()
    out = spark.read.parquet(f"{root}/out").collect()
    assert {r["topic"] for r in out} == {f"topic-{kind}" for kind in layouts.PUBLISHED}
    assert len(out) == 4 and all(r["key"].startswith("session_") for r in out)
    assert {bytes(r["headers"][0]["value"]).decode() for r in out} == {trace(n) for n in range(4)}


def test_arrival_clock_streams(spark):
    root = scratch.new_folder(spark, "t")
    land(spark, f"{root}/in", [record(telemetry([s]), s) for s in (1, 2)])
    run(spark, root, clock="arrival")
    land(spark, f"{root}/in", [record(telemetry([3]), 3)])
    run(spark, root, clock="arrival")
    # both rows of the first load arrived together and so share a window
    rows = warehouse.read(spark, f"{root}/wh", "speed_aggregation").collect()
    assert [(r["sample_count"], r["avg_speed"]) for r in rows][0] == (2, 1.5)


def test_ungathered_records_are_written_where_they_are(spark, tmp_path):
    rows = spark.range(0, 900, 1, 3).selectExpr("cast(id as string) AS key", "repeat(cast(id as string), 50) AS value")
    sinks.FeedSink("parquet", {"path": str(tmp_path / "out")}).write(rows, "b", gather=False)
    files = list((tmp_path / "out").rglob("*.zstd.parquet"))
    assert len(files) == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 900
