"""Between keyed records and typed rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow.functions import ids, traces
from paddockflow.schemas import FEEDS, columns

# --- packets -----------------------------------------------------------------------


def read_packets(records: DataFrame, schema: str) -> DataFrame:
    """JSON records as packet columns, plus ``traceparent`` and ``timestamp``.

    Text that does not parse becomes a row of NULLs, so it stays countable.
    """
    parsed = records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        traces.from_headers(F.col("headers")).alias("traceparent"),
        "timestamp",
    ).select("data.*", "traceparent", "timestamp")
    uid = ids.signed_uid(F.col("m_header.m_session_uid"))
    return parsed.withColumn("m_header", F.col("m_header").withField("m_session_uid", uid))


def packet_records(
    decoded: DataFrame,
    kinds: list[str],
    trace_id: Column,
    span_id: Column,
    keep: Sequence[str] = (),
    topics: dict[str, str] | None = None,
) -> DataFrame:
    """Decoded datagrams as keyed JSON records with their trace parent header.

    Decode with ``nan_as_null``, since JSON has no NaN.  The session id is written
    unsigned, as it was on the wire.  ``topics`` names a topic per kind, for sinks
    that take all kinds in one write.
    """

    def json_of(kind: str) -> Column:
        uid = ids.unsigned_uid(F.col(f"{kind}.m_header.m_session_uid"))
        packet = F.col(kind).withField("m_header.m_session_uid", uid)
        return F.when(F.col(kind).isNotNull(), F.to_json(packet))

    uid = F.coalesce(*[F.col(f"{kind}.m_header.m_session_uid") for kind in kinds])
    topic = F.coalesce(
        *[F.when(F.col("packet_kind") == kind, name) for kind, name in (topics or {}).items()],
        F.lit(None).cast("string"),
    )
    return decoded.where(F.col("packet_kind").isin(*kinds)).select(
        "packet_kind",
        ids.packet_key(uid).alias("key"),
        F.coalesce(*[json_of(kind) for kind in kinds]).alias("value"),
        traces.to_headers(traces.make(trace_id, span_id)).alias("headers"),
        *([topic.alias("topic")] if topics else []),
        *keep,
    )


# --- aggregate feeds ---------------------------------------------------------------


def feed_records(aggregates: DataFrame) -> DataFrame:
    """Aggregate rows keyed by session; NULL fields are left out of the JSON."""
    return aggregates.select(
        ids.feed_key(F.col("session_uid")).alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


# Only what JSON itself allows.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _sound(feed: str) -> Column:
    """The parsed record in an array, which is empty when the record is not valid.

    A record is valid when its text is UTF-8 and one JSON object with nothing after it, and
    all eight fields are there once, with their types and finite; other fields are ignored.
    Filtering the parsed struct inside an array lets every check share one parse.
    """
    text = F.col("value").cast("string")
    fields = columns(FEEDS[feed])
    names = [name for name, _ in fields]
    # text fields are read as they stand, since the parser would turn a number into text
    schema = ", ".join(f"{name} {'VARIANT' if kind == 'STRING' else kind}" for name, kind in fields)

    def usable(value: Column, kind: str) -> Column:
        if kind == "STRING":
            return F.schema_of_variant(value) == "STRING"
        if kind in ("FLOAT", "DOUBLE"):
            return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
        return value.isNotNull()

    def valid(data: Column) -> Column:
        alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
        keys = F.filter(F.json_object_keys(text), lambda key: key.isin(*names))
        checks = [usable(data[name], kind) for name, kind in fields]
        return reduce(lambda a, b: a & b, [F.is_valid_utf8(text), *checks, alone, F.size(keys) == len(names)])

    def typed(data: Column) -> Column:
        return F.struct(*[
            (F.variant_get(data[name], "$", "string") if kind == "STRING" else data[name]).alias(name)
            for name, kind in fields
        ])

    return F.transform(F.filter(F.array(F.from_json(text, schema, _STRICT)), valid), typed)


def valid_feed(records: DataFrame, feed: str) -> DataFrame:
    """The valid records of an aggregate feed, as typed rows."""
    return records.select(F.inline(_sound(feed)))


def reject_feed(records: DataFrame, feed: str) -> DataFrame:
    """The records :func:`valid_feed` leaves out, as they came."""
    return records.where(F.size(_sound(feed)) == 0)


def message(feed: str, fields: list[str]) -> Column:
    """``{"type": ..., "data": {...}}`` text."""
    return F.to_json(F.struct(F.lit(feed).alias("type"), F.struct(*fields).alias("data")))


def messages(records: DataFrame, feed: str) -> DataFrame:
    """Valid records of a feed as tagged messages."""
    rows = valid_feed(records, feed)
    return rows.select(
        F.lit(feed).alias("type"), message(feed, rows.columns).alias("message")
    )


def merge_feeds(speed_records: DataFrame, rpm_records: DataFrame) -> DataFrame:
    """Both feeds as one stream of tagged messages."""
    return messages(speed_records, "speed").unionByName(messages(rpm_records, "rpm"))


def messages_once(speed_records: DataFrame, rpm_records: DataFrame, delay: str) -> DataFrame:
    """As :func:`merge_feeds`, with one message for each window of a session and feed.

    A batch that was written again after a failure is in the feed twice; the first of both is
    taken.  On a stream what was seen is remembered until the watermark, ``delay`` behind the
    newest window, has passed it, and a message that comes later still is dropped.  A window
    whose start is no time can't be remembered like that: its messages all pass.
    """

    def keyed(records: DataFrame, feed: str) -> DataFrame:
        rows = valid_feed(records, feed)
        at = F.try_to_timestamp("window_start").alias("_at")
        return rows.select(
            F.lit(feed).alias("type"), message(feed, rows.columns).alias("message"), "session_uid", at
        )

    both = keyed(speed_records, "speed").unionByName(keyed(rpm_records, "rpm"))
    timed, key = both.where("_at is not null"), ["type", "session_uid", "_at"]
    once = timed.withWatermark("_at", delay).dropDuplicatesWithinWatermark(key) if both.isStreaming else timed.dropDuplicates(key)
    return once.unionByName(both.where("_at is null")).select("type", "message")


def dispatch(tagged: DataFrame, feed: str, text: str = "message") -> DataFrame:
    """The rows of one type out of tagged message text."""
    schema = ", ".join(f"{name}: {kind}" for name, kind in columns(FEEDS[feed]))
    parsed = tagged.select(F.from_json(text, f"type STRING, data STRUCT<{schema}>").alias("m"))
    return parsed.where(F.col("m.type") == feed).select("m.data.*")
