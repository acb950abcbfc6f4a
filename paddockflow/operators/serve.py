"""Reads behind a live view: first and latest rows, short histories, chart series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddockflow.functions import display

# Sizes of the live view.
HISTORY_ROWS = 50
CHART_ROWS = 20
CHART_SECONDS = 60
CHART_LEAD_SECONDS = 5


def first_per_kind(rows: DataFrame, kind: str, order: str, tie: str) -> DataFrame:
    """The first row of each kind by ``order``, then ``tie``.

    NULL is a kind too, and a kind whose rows all lack ``order`` still has a first row.  Spark
    keeps one row per kind and task ahead of the shuffle.
    """
    return _ranked(rows, kind, [F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_last()], "_rank", 1).drop("_rank")


def latest_per_kind(rows: DataFrame, kind: str, order: str, tie: str) -> DataFrame:
    """The last row of each kind by ``order``, then ``tie``; rows without ``order`` come first."""
    return _ranked(rows, kind, [F.col(order).desc_nulls_last(), F.col(tie).desc_nulls_last()], "_rank", 1).drop("_rank")


def _ranked(rows: DataFrame, kind: str, order: Sequence[Column], name: str, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= n)


def first_seen(rows: DataFrame, kind: str, order: str) -> DataFrame:
    """Kinds seen so far and the lowest order value of each; also runs on a stream."""
    return rows.groupBy(kind).agg(F.min(order).alias(f"first_{order}"))


def last_n(
    rows: DataFrame, kind: str, order: Sequence[str], n: int = HISTORY_ROWS, groups: int | None = None
) -> DataFrame:
    """The last ``n`` rows of each kind.

    Up to Spark's own threshold (1000) each task is limited to ``n`` rows per kind ahead of
    the shuffle.  Beyond it no such limit exists, so a large ``n`` is ranked twice: within
    ``groups`` hashed parts of each kind, then among what they leave, at most ``groups * n``
    rows of a kind.  ``groups`` is the number of shuffle partitions unless given.
    """
    newest = [F.col(c).desc() for c in order]
    session = rows.sparkSession
    if n > int(session.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = groups or int(session.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(*order), F.lit(parts))
        within = F.row_number().over(Window.partitionBy(kind, "_part").orderBy(*newest))
        rows = (
            rows.withColumn("_part", part).withColumn("_within", within)
            .where(F.col("_within") <= n).drop("_part", "_within")
        )
    return _ranked(rows, kind, newest, "recency", n)


def chart_rows(
    aggregates: DataFrame,
    kind: str,
    order: Sequence[str],
    now: datetime | Column,
    n: int = CHART_ROWS,
    seconds: int = CHART_SECONDS,
    lead: int = CHART_LEAD_SECONDS,
) -> DataFrame:
    """Rows inside the chart: among the last ``n``, from ``now - seconds`` to ``now + lead``.

    The lower bound only removes rows that rank behind all others, so it is applied
    first, where it reaches the scan.
    """
    at = now if isinstance(now, Column) else F.lit(now)
    start = F.col(order[0])
    recent = aggregates.where(start >= at - F.make_dt_interval(secs=F.lit(seconds)))
    shown = last_n(recent, kind, order, n)
    return shown.where(start <= at + F.make_dt_interval(secs=F.lit(lead)))


def first_rows(rows: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in an order (a bare LIMIT would return any)."""
    return rows.orderBy(*order).limit(n)


def current_session(latest_speed: DataFrame, latest_rpm: DataFrame) -> DataFrame:
    """Session id and time on show: the speed feed's, else the rev feed's.

    Both inputs are latest rows, one at most; the result is always one row.
    """

    def tagged(rows: DataFrame, feed: str) -> DataFrame:
        return rows.select("session_uid", "session_time", F.lit(feed).alias("feed"))

    def preferred(column: str) -> Column:
        of = {feed: F.max(F.when(F.col("feed") == feed, F.col(column))) for feed in ("speed", "rpm")}
        return F.coalesce(of["speed"], of["rpm"]).alias(column)

    both = tagged(latest_speed, "speed").unionByName(tagged(latest_rpm, "rpm"))
    return both.agg(preferred("session_uid"), preferred("session_time"))


def chart_series(aggregates: DataFrame, measure: str) -> DataFrame:
    """One (series, x, y) point per aggregate row and each of Min, Avg and Max.

    x is in epoch milliseconds, from a timestamp or from the feed's ISO text; NULL where that
    text is no time.
    """
    start = F.col("window_start")
    is_text = dict(aggregates.dtypes)["window_start"] == "string"
    values = [f"{stat}_{measure}" for stat in ("min", "avg", "max")]
    points = aggregates.select(
        "session_uid",
        (display.epoch_ms(start) if is_text else F.unix_millis(start)).alias("x"),
        *[F.col(value).cast("double").alias(label) for value, label in zip(values, ("Min", "Avg", "Max"))],
    )
    return points.unpivot(["session_uid", "x"], ["Min", "Avg", "Max"], "series", "y")
