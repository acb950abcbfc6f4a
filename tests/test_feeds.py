import json

import pytest
from pyspark.sql import functions as F

from paddockflow import schemas
from paddockflow.operators import envelope, project, serve
from paddockflow.plans import feeds, streams
from rows import at, header, records, record

GOOD = {
    "window_start": "2025-01-01T00:00:00.000Z", "window_end": "2025-01-01T00:00:01.000Z",
    "session_uid": 7, "session_time": 1.5, "avg_speed": 100.5, "min_speed": 100, "max_speed": 101,
    "sample_count": 2,
}


def feed(spark, values):
    data = [(i, v if isinstance(v, (bytes, type(None))) else json.dumps(v).encode()) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "n int, value binary")


@pytest.mark.parametrize(
    "change, valid",
    [({}, True), ({"extra": 1}, True), ({"min_speed": None}, False), ({"min_speed": "100"}, False),
     ({"min_speed": 3_000_000_000}, False), ({"window_start": 5}, False), ({"session_time": 2}, True),
     ({"avg_speed": "NaN"}, False), ({"sample_count": 1.5}, False)],
)
def test_validation(spark, change, valid):
    rows = feed(spark, [{**GOOD, **change}])
    assert envelope.valid_feed(rows, "speed").count() == int(valid)
    assert envelope.reject_feed(rows, "speed").count() == int(not valid)


def test_unusable_records(spark):
    missing = {k: v for k, v in GOOD.items() if k != "max_speed"}
    bad_utf8 = json.dumps(GOOD).encode().replace(b'"window_start": "2025', b'"window_start": "\xff025')
    rows = feed(spark, [None, b"", b"\xff\xfe", b"oops", bad_utf8, missing, GOOD])
    assert [r["sample_count"] for r in envelope.valid_feed(rows, "speed").collect()] == [2]
    assert {r["n"] for r in envelope.reject_feed(rows, "speed").collect()} == set(range(6))


def test_null_field_is_left_out_and_then_rejected(spark):
    aggregate = spark.createDataFrame(
        [(at(0), at(1), 7, 1.5, None, None, None, 1)], schemas.WAREHOUSE["speed_aggregation"]
    )
    out = envelope.feed_records(aggregate)
    assert json.loads(out.first()["value"]) == {
        "window_start": "2025-01-01T00:00:00.000Z", "window_end": "2025-01-01T00:00:01.000Z",
        "session_uid": 7, "session_time": 1.5, "sample_count": 1,
    }
    assert out.first()["key"] == "7"
    assert envelope.valid_feed(out.select(F.col("value").cast("binary").alias("value")), "speed").count() == 0


def test_merge_and_dispatch(spark):
    rpm = {k.replace("speed", "rpm"): v for k, v in GOOD.items()}
    merged = envelope.merge_feeds(feed(spark, [GOOD]), feed(spark, [rpm, {"no": 1}]))
    by_type = {r["type"]: json.loads(r["message"]) for r in merged.collect()}
    assert by_type == {"speed": {"type": "speed", "data": GOOD}, "rpm": {"type": "rpm", "data": rpm}}
    assert envelope.dispatch(merged, "rpm").first()["avg_rpm"] == 100.5
    assert envelope.dispatch(merged, "rpm").count() == 1


def test_dimension_rows(spark):
    name = list("Zoë".encode()) + [0] * 28
    driver = {
        "m_ai_controlled": 0, "m_driver_id": 9, "m_team_id": 2, "m_race_number": 44,
        "m_nationality": 10, "m_name": name, "m_platform": 1,
    }
    player = {
        "m_ai_controlled": 1, "m_team_id": 2, "m_nationality": 3, "m_platform": 4, "m_name": name,
        "m_car_number": 5, "m_ready_status": 1,
    }
    recs = records(spark, [record(json.dumps({"m_header": header(), "m_participants": [driver]})),
                           record(json.dumps({"m_header": header(player=255), "m_participants": [driver]}))])
    got = project.participant_rows(envelope.read_packets(recs, schemas.PARTICIPANTS_JSON))
    assert got.drop("traceparent").columns == schemas.names("participants")
    assert [r["name"] for r in got.collect()] == ["Zoë", None]
    recs = records(spark, [record(json.dumps({"m_header": header(), "m_lobby_players": [player]}))])
    got = project.lobby_rows(envelope.read_packets(recs, schemas.LOBBY_JSON))
    assert got.drop("traceparent").columns == schemas.names("lobby_info")
    row = got.first()
    assert (row["name"], row["car_number"], row["platform"], row["ready_status"]) == ("Zoë", 5, 4, 1)


def numbered(spark, n, kinds=("a", "b")):
    return spark.createDataFrame(
        [(kinds[i % len(kinds)], i // 4, i) for i in range(n)], "kind string, t int, id int"
    )


def test_first_latest_and_history(spark):
    rows = numbered(spark, 203)
    first = {r["kind"]: r["id"] for r in serve.first_per_kind(rows, "kind", "t", "id").collect()}
    last = {r["kind"]: r["id"] for r in serve.latest_per_kind(rows, "kind", "t", "id").collect()}
    assert first == {"a": 0, "b": 1} and last == {"a": 202, "b": 201}
    history = serve.last_n(rows, "kind", ["t", "id"], 50)
    assert history.count() == 100
    assert min(r["id"] for r in history.where("kind = 'a'").collect()) == 202 - 2 * 49


def test_history_is_limited_ahead_of_the_shuffle(spark):
    plan = serve.last_n(numbered(spark, 10), "kind", ["t"], 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one below the exchange, one above


def test_chart_window(spark):
    rows = spark.createDataFrame([("s", at(n), n) for n in range(100)], "kind string, ts timestamp, n int")
    got = serve.chart_rows(rows, "kind", ["ts"], at(90), n=20).collect()
    assert sorted(r["n"] for r in got) == list(range(80, 96))  # last 20, up to now + 5
    old = serve.chart_rows(rows, "kind", ["ts"], at(150), n=20).collect()
    assert sorted(r["n"] for r in old) == list(range(90, 100))  # last 60 seconds


def test_current_session(spark):
    schema = "session_uid long, session_time float"
    speed, rpm = spark.createDataFrame([(1, None)], schema), spark.createDataFrame([(2, 2.5)], schema)
    none = speed.limit(0)
    assert tuple(serve.current_session(speed, rpm).first()) == (1, 2.5)
    assert tuple(serve.current_session(none, rpm).first()) == (2, 2.5)
    assert tuple(serve.current_session(none, none).first()) == (None, None)


def test_chart_series(spark):
    rows = spark.createDataFrame([(GOOD["window_start"], 7, 1, 2.5, 4)], "window_start string, session_uid long, min_speed int, avg_speed double, max_speed int")
    got = {(r["series"], r["x"], r["y"]) for r in serve.chart_series(rows, "speed").collect()}
    x = 1735689600000
    assert got == {("Min", x, 1.0), ("Avg", x, 2.5), ("Max", x, 4.0)}


def test_kinds_are_not_listed(spark):
    rows = spark.createDataFrame(
        [("new", 5, 1), ("new", 9, 2), (None, 3, 3), ("late", None, 4), ("late", None, 5)], "kind string, t int, id int"
    )
    last = {r["kind"]: r["id"] for r in serve.latest_per_kind(rows, "kind", "t", "id").collect()}
    first = {r["kind"]: r["id"] for r in serve.first_per_kind(rows, "kind", "t", "id").collect()}
    assert last == {"new": 2, None: 3, "late": 5} and first == {"new": 1, None: 3, "late": 4}


def test_a_long_history_is_ranked_in_parts_first(spark):
    rows = numbered(spark, 6000)
    got = serve.last_n(rows, "kind", ["t", "id"], 1500, groups=4)
    assert sorted(r["id"] for r in got.where("kind = 'a'").collect()) == list(range(6000 - 3000, 6000, 2))
    assert got.columns == ["kind", "t", "id", "recency"]
    assert got._jdf.queryExecution().executedPlan().toString().count("Window [") == 2


GOOD_SPEED = json.dumps(GOOD)
SPOILED = {
    "text after it": GOOD_SPEED + " xyz",
    "a second object": GOOD_SPEED + ", {}",
    "single quotes": GOOD_SPEED.replace('"', "'"),
    "a repeated field": GOOD_SPEED[:-1] + ', "avg_speed": 1.0}',
    "infinity as text": json.dumps({**GOOD, "session_time": "Infinity"}),
    "minus infinity as text": json.dumps({**GOOD, "avg_speed": "-Infinity"}),
    "bare infinity": GOOD_SPEED.replace(json.dumps(GOOD["avg_speed"]), "Infinity"),
    "a number beyond all": GOOD_SPEED.replace(json.dumps(GOOD["avg_speed"]), "1e400"),
    "numeric start beside a nested one": json.dumps({**GOOD, "window_start": 5, "x": {"window_start": "q"}}),
    "number as text": json.dumps({**GOOD, "session_uid": "7"}),
    "an array": "[" + GOOD_SPEED + "]",
}


def test_feed_validation_is_strict(spark):
    cases = {"good": GOOD_SPEED, "spaces": f"  {GOOD_SPEED}\n", "more fields": json.dumps({**GOOD, "z": [1]}), **SPOILED}
    rows = spark.createDataFrame(list(cases.items()), "name string, value string")
    refused = {r["name"] for r in envelope.reject_feed(rows, "speed").collect()}
    assert refused == set(SPOILED)
    assert envelope.valid_feed(rows, "speed").count() == 3


def test_a_bad_chart_time_is_null(spark):
    rows = spark.createDataFrame([("soon", 7, 1, 2.5, 4)], "window_start string, session_uid long, min_speed int, avg_speed double, max_speed int")
    assert {r["x"] for r in serve.chart_series(rows, "speed").collect()} == {None}


def test_tasks_grow_with_the_table(spark, tmp_path):
    rows = 6 * feeds.TASK_ROWS
    spark.range(rows).coalesce(1).write.parquet(str(tmp_path / "one"))
    stored = spark.read.parquet(str(tmp_path / "one"))
    parts = feeds.spread(stored, stored).rdd.glom().map(len).collect()
    assert sum(parts) == rows and max(parts) <= 1.1 * feeds.TASK_ROWS


def test_state_is_split_by_the_rows_of_a_table(spark, sf_dir, monkeypatch, tmp_path):
    stored = spark.range(100_000)
    assert [feeds.state_partitions(stored, least) for least in (None, 2, 9)] == [4, 4, 9]
    monkeypatch.setattr(feeds, "TASK_ROWS", 100)
    assert feeds.state_partitions(stored) == 1000
    events = feeds.table(spark, sf_dir, "events").limit(700)
    events.write.parquet(str(tmp_path / "events.parquet"))
    folder = str(tmp_path / "lap")
    monkeypatch.setattr(streams.scratch, "new_folder", lambda _spark, _label: folder)
    streams.stream_lap_table(spark, str(tmp_path)).collect()
    state = [d for d in (tmp_path / "lap" / "cp" / "lap" / "state" / "0").iterdir() if d.name.isdigit()]
    assert len(state) == 7
