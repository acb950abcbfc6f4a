import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from paddockflow import schemas
from paddockflow.operators import envelope, lineage, project, windows
from rows import START, at, header, record, records, telemetry, trace


def rows_of(spark, recs):
    return project.telemetry_rows(envelope.read_packets(records(spark, recs), schemas.TELEMETRY_JSON))


def test_speed_window(spark):
    rows = rows_of(spark, [
        record(telemetry([100]), 0.0), record(telemetry([103]), 0.999), record(telemetry([250]), 1.0),
        record(telemetry([5], player=255), 1.5, trace(1)), record("{oops", 1.6),
    ])
    got = {(r["window_start"], r["session_uid"]): r for r in windows.speed_windows(rows).collect()}
    start = START.replace(tzinfo=None)
    first = got[start, 7]
    assert (first["avg_speed"], first["min_speed"], first["max_speed"], first["sample_count"]) == (101.5, 100, 103, 2)
    assert first["window_end"] - first["window_start"] == timedelta(seconds=1)
    second = got[start + timedelta(seconds=1), 7]
    assert (second["avg_speed"], second["sample_count"]) == (250.0, 2)  # the NULL speed is counted
    lost = got[start + timedelta(seconds=1), None]
    assert (lost["avg_speed"], lost["min_speed"], lost["sample_count"]) == (None, None, 1)


def test_column_order_is_the_table_order(spark):
    rows = rows_of(spark, [record(telemetry())])
    assert windows.speed_windows(rows).columns == schemas.names("speed_aggregation")
    assert windows.rpm_windows(rows).columns == schemas.names("rpm_aggregation")
    assert [t for _, t in windows.speed_windows(rows).dtypes] == [
        t.lower() for _, t in schemas.columns(schemas.WAREHOUSE["speed_aggregation"])
    ]


def test_large_session_id(spark):
    rows = rows_of(spark, [record(telemetry(uid=2**63 + 7))])
    assert rows.first()["session_uid"] == -9223372036854775801


def test_missing_and_extra_fields(spark):
    text = json.dumps({"z": 2, "m_header": {"m_session_uid": 3, "m_player_car_index": 0}, "q": [1]})
    row = rows_of(spark, [record(text)]).first()
    assert (row["session_uid"], row["session_time"], row["speed"]) == (3, None, None)


def test_narrow_schema_reads_the_wide_packet_alike(spark):
    """A field of the wrong type elsewhere in the packet costs nothing."""
    text = telemetry([9]).replace('"m_speed": 9', '"m_throttle": "abc", "m_speed": 9')
    assert rows_of(spark, [record(text)]).first()["speed"] == 9


def test_arrival_clock_is_one_instant(spark):
    packets = envelope.read_packets(
        records(spark, [record(telemetry(), s) for s in range(5)]), schemas.TELEMETRY_JSON
    )
    rows = project.telemetry_rows(packets, clock="arrival")
    assert rows.select("timestamp").distinct().count() == 1
    assert rows.first()["timestamp"] != at(0)


def test_two_levels_equal_one(spark):
    recs = [
        record(telemetry([n % 50], player=0 if n % 7 else 255, uid=n % 3, time=n / 4), n / 3, trace(n % 11) if n % 4 else None)
        for n in range(200)
    ]
    rows = rows_of(spark, recs)
    direct = windows.telemetry_windows(rows)
    merged = windows.merge_trace_windows(windows.trace_windows(rows)).drop("link_count")
    assert sorted(map(str, direct.select(sorted(direct.columns)).collect())) == sorted(
        map(str, merged.select(sorted(merged.columns)).collect())
    )


def lap_packet(current, sector, frame, player=0):
    car = {
        "m_last_lap_time_in_ms": 75000, "m_current_lap_time_in_ms": current,
        "m_sector1_time_minutes_part": 1, "m_sector1_time_ms_part": sector,
        "m_sector2_time_minutes_part": 0, "m_sector2_time_ms_part": 750, "m_car_position": 3,
        "m_current_lap_num": 5, "m_num_pit_stops": 1, "m_penalties": 0, "m_total_warnings": 2,
        "m_corner_cutting_warnings": 1, "m_grid_position": 1, "m_speed_trap_fastest_speed": 320.5,
    }
    return json.dumps({"m_header": header(frame=frame, player=player), "m_lap_data": [car]})


def test_lap_windows_max_and_latest(spark):
    recs = [record(lap_packet(74000, 23456, 1), 1), record(lap_packet(200, 100, 2), 4.9), record(lap_packet(900, 5, 3), 5)]
    packets = envelope.read_packets(records(spark, recs), schemas.LAP_JSON)
    by_max = windows.lap_windows(project.lap_rows(packets)).orderBy("window_start").collect()
    assert [(r["current_lap_time_ms"], r["sector1_time_ms"], r["sample_count"]) for r in by_max] == [
        (74000, 83456, 2), (900, 60005, 1),
    ]
    assert list(by_max[0].__fields__) == schemas.names("lap")
    latest = windows.lap_windows(project.lap_rows(packets, frame=True), latest=True).orderBy("window_start").first()
    assert (latest["current_lap_time_ms"], latest["sector1_time_ms"]) == (200, 60100)


def test_aggregates_stay_in_hash_aggregation(spark):
    rows = rows_of(spark, [record(telemetry())])
    plan = windows.telemetry_windows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_window_lineage_keeps_the_null_session(spark):
    rows = rows_of(spark, [record("{oops", 0, trace(1)), record(telemetry(), 0.5, trace(2)), record(telemetry(), 0.6)])
    got = lineage.window_lineage(windows.trace_windows(rows, [], "1 second"), "s").collect()
    assert {(r["session_uid"], r["sample_count"], int(r["trace_id"], 16)) for r in got} == {(None, 1, 1), (7, 2, 2)}


def test_trace_policies(spark):
    rows = spark.createDataFrame([("bad",), ("00-a-b-01",), (None,), ("00-a-b-01",)], "traceparent string")
    kept = lineage.packet_spans(rows, "w", "quarantine").collect()
    assert [(r["trace_id"], r["span_id"], r["event"]) for r in kept] == [("a", "b", "w_complete")]
    assert [r["traceparent"] for r in lineage.bad_traces(rows).collect()] == ["bad"]
    with pytest.raises(Exception, match="invalid traceparent format"):
        lineage.packet_spans(rows, "w").collect()
    with pytest.raises(ValueError):
        lineage.packet_spans(rows, "w", "ignore")


def test_quarantined_parents_are_no_links(spark):
    good = trace(1)
    rows = rows_of(spark, [record(telemetry(), 0.1, "bad"), record(telemetry(), 0.2, good), record(telemetry(), 1.2, "bad")])
    partials = windows.trace_windows(rows)
    spans = lineage.window_spans(windows.merge_trace_windows(partials), "s").collect()
    links = lineage.span_links(partials, ["s", "t"], "quarantine").collect()
    assert [r["link_count"] for r in spans] == [1]
    assert sorted(r["span_name"] for r in links) == ["s", "t"]
    assert lineage.bad_traces(partials).count() == 2
