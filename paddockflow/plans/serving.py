"""First, latest, history and chart queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddockflow.functions import display
from paddockflow.operators import serve, windows
from paddockflow.plans import feeds, sql
from paddockflow.plans.batch import plain, query, telemetry_rows


def _events(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )


@query(
    "latest_per_type",
    """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""",
)
def latest_per_type(spark, sf_dir):
    return serve.latest_per_kind(_events(spark, sf_dir), "event_type", "ts", "event_id")


@query(
    "first_per_kind",
    """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1
""",
)
def first_per_kind(spark, sf_dir):
    return serve.first_per_kind(_events(spark, sf_dir), "event_type", "ts", "event_id")


@query(
    "first_seen",
    "SELECT event_type, min(event_id) AS first_event_id FROM events GROUP BY event_type",
)
def first_seen(spark, sf_dir):
    return serve.first_seen(_events(spark, sf_dir), "event_type", "event_id")


def _last_n(n: int) -> str:
    return f"""
SELECT event_id, ts, user_id, event_type, value,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS INT) AS recency
FROM events QUALIFY recency <= {n}
"""


@query("history_50", _last_n(50))
def history_50(spark, sf_dir):
    return serve.last_n(_events(spark, sf_dir), "event_type", ["ts", "event_id"])


@query("chart_last_20", _last_n(20))
def chart_last_20(spark, sf_dir):
    return serve.last_n(_events(spark, sf_dir), "event_type", ["ts", "event_id"], serve.CHART_ROWS)


@query(
    "chart_window",
    """
WITH c AS (SELECT TIMESTAMP '2024-01-30 12:00:00' AS now),
r AS (SELECT event_id, ts, user_id, event_type, value,
             CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS INT) AS recency
      FROM events)
SELECT r.* FROM r, c
WHERE recency <= 400 AND ts >= now - INTERVAL 3 DAY AND ts <= now + INTERVAL 6 HOUR
""",
)
def chart_window(spark, sf_dir):
    """The chart's bounds, scaled up to the sparse event table."""
    hour = 3600
    return serve.chart_rows(
        _events(spark, sf_dir), "event_type", ["ts", "event_id"],
        F.to_timestamp_ntz(F.lit("2024-01-30 12:00:00")), n=400, seconds=72 * hour, lead=6 * hour,
    )


@query("ordered_limit", "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def ordered_limit(spark, sf_dir):
    return serve.first_rows(_events(spark, sf_dir), ["event_id"])


@query(
    "session_clock",
    """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN '--:--:--'
            ELSE printf('%02d:%02d:%02d', CAST(floor(o_totalprice) AS BIGINT) // 3600,
                        CAST(floor(o_totalprice) AS BIGINT) % 3600 // 60,
                        CAST(floor(o_totalprice) AS BIGINT) % 60) END AS clock
FROM orders
""",
)
def session_clock(spark, sf_dir):
    seconds = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    rows = feeds.table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", display.session_clock(seconds).alias("clock"))


@query(
    "epoch_ms",
    """
SELECT event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) // 1000 END AS x FROM events
""",
)
def epoch_ms(spark, sf_dir):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    text = F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(iso)
    return _events(spark, sf_dir).select("event_id", display.epoch_ms(text).alias("x"))


@query(
    "chart_series",
    sql.PACKETS
    + f", w AS ({sql.telemetry_windows(3600, ['speed'])})"
    + " UNION ALL ".join(
        f" SELECT session_uid, epoch_ms(window_start) AS x, '{label}' AS series, "
        f"CAST({stat}_speed AS DOUBLE) AS y FROM w"
        for stat, label in (("min", "Min"), ("avg", "Avg"), ("max", "Max"))
    ),
)
def chart_series(spark, sf_dir):
    rows = windows.speed_windows(telemetry_rows(spark, sf_dir), "1 hour")
    return serve.chart_series(rows, "speed")


def _newest(kind: str) -> str:
    return f"""(SELECT user_id, value FROM events WHERE event_type = '{kind}'
                ORDER BY ts DESC, event_id DESC LIMIT 1)"""


def _on_show(spark, sf_dir, speed, rpm):
    rows = _events(spark, sf_dir)

    def latest(kind):
        of_kind = rows.where(F.col("event_type") == kind)
        return serve.latest_per_kind(of_kind, "event_type", "ts", "event_id").select(
            F.col("user_id").alias("session_uid"), F.col("value").alias("session_time")
        )

    return serve.current_session(latest(speed), latest(rpm))


@query(
    "current_session",
    f"""
SELECT coalesce(n.user_id, v.user_id) AS session_uid, coalesce(n.value, v.value) AS session_time
FROM (SELECT 1 AS one) o LEFT JOIN {_newest("none")} n ON true LEFT JOIN {_newest("view")} v ON true
""",
)
def current_session(spark, sf_dir):
    """A type that no event has stands for a speed feed that has sent nothing yet."""
    return _on_show(spark, sf_dir, "none", "view")


@query(
    "current_session_speed",
    f"""
SELECT coalesce(n.user_id, v.user_id) AS session_uid, coalesce(n.value, v.value) AS session_time
FROM (SELECT 1 AS one) o LEFT JOIN {_newest("click")} n ON true LEFT JOIN {_newest("view")} v ON true
""",
)
def current_session_speed(spark, sf_dir):
    """Clicks stand for the speed feed, which wins over the revs."""
    return _on_show(spark, sf_dir, "click", "view")


@query(
    "history_2000",
    _last_n(2000),
)
def history_2000(spark, sf_dir):
    """More rows than Spark limits by itself."""
    return serve.last_n(_events(spark, sf_dir), "event_type", ["ts", "event_id"], 2000)
