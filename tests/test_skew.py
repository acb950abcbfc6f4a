"""One session and window with a third of all rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paddockflow import schemas
from paddockflow.operators import envelope, lineage, project, windows
from rows import at, record, records, telemetry, trace

TOTAL = 3000


@pytest.fixture(scope="module")
def packets():
    out = []
    for n in range(TOTAL):
        hot = n % 3 == 0
        out.append((0 if hot else 1 + n % 40, 0.0 if hot else float(n % 17), n % 300, n))
    return out


@pytest.fixture(scope="module")
def rows(spark, packets):
    recs = [record(telemetry([speed], uid=uid), second, trace(n)) for uid, second, speed, n in packets]
    read = envelope.read_packets(records(spark, recs), schemas.TELEMETRY_JSON)
    return project.telemetry_rows(read)


@pytest.fixture()
def shuffled_joins(spark):
    """Plans as for large inputs: no broadcast, no adaptive merging."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def brute(packets):
    groups = defaultdict(list)
    for uid, second, speed, n in packets:
        groups[uid, int(second)].append((speed, n))
    return groups


def test_windows(rows, packets):
    expected = {k: (sum(s for s, _ in v) / len(v), min(v)[0], max(v)[0], len(v)) for k, v in brute(packets).items()}
    start = at(0).replace(tzinfo=None)
    for result in (windows.speed_windows(rows), windows.merge_trace_windows(windows.trace_windows(rows))):
        got = {
            (r["session_uid"], (r["window_start"] - start).seconds): (r["avg_speed"], r["min_speed"], r["max_speed"], r["sample_count"])
            for r in result.collect()
        }
        assert got == expected


def test_only_one_row_per_window_and_task_is_shuffled(spark, rows, shuffled_joins):
    plan = windows.speed_windows(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") > plan.index("Exchange")  # the partial step is below


def test_lineage_has_every_link(spark, rows, packets, shuffled_joins):
    joined = lineage.window_lineage(windows.trace_windows(rows, [], "1 second"), "s")
    out = joined.collect()
    sizes = {k: len(v) for k, v in brute(packets).items()}
    assert len(out) == TOTAL
    assert all(r["sample_count"] == sizes[r["session_uid"], (r["window_start"] - at(0).replace(tzinfo=None)).seconds] for r in out)
