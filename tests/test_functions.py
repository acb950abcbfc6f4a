import pytest
from pyspark.sql import functions as F

from paddockflow.functions import display, ids, packets, traces


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def decimal(n):
    return F.lit(str(n)).cast("decimal(20,0)")


@pytest.mark.parametrize(
    "unsigned, signed",
    [(0, 0), (12345, 12345), (2**63 - 1, 2**63 - 1), (2**63, -(2**63)),
     (2**63 + 7, -9223372036854775801), (2**64 - 1, -1)],
)
def test_session_id_wraps_and_back(spark, unsigned, signed):
    assert one(spark, ids.signed_uid(decimal(unsigned))) == signed
    assert int(one(spark, ids.unsigned_uid(F.lit(signed).cast("bigint")))) == unsigned
    assert one(spark, ids.packet_key(F.lit(signed).cast("bigint"))) == f"session_{unsigned}"
    assert one(spark, ids.feed_key(F.lit(signed).cast("bigint"))) == str(signed)


def test_session_id_null(spark):
    assert one(spark, ids.signed_uid(F.lit(None).cast("decimal(20,0)"))) is None


@pytest.mark.parametrize("index, expected", [(0, 10), (2, 30), (3, None), (255, None), (-1, None)])
def test_element_out_of_range_is_null(spark, index, expected):
    assert one(spark, packets.element(F.array(*map(F.lit, (10, 20, 30))), F.lit(index))) == expected


@pytest.mark.parametrize("minutes, ms, expected", [(1, 23456, 83456), (0, 500, 500), (None, 5, None), (3, None, None)])
def test_split_time(spark, minutes, ms, expected):
    assert one(spark, packets.split_ms(F.lit(minutes).cast("int"), F.lit(ms).cast("int"))) == expected


def codes(data: bytes):
    return F.array(*[F.lit(b) for b in data.ljust(32, b"\0")])


@pytest.mark.parametrize(
    "data, expected",
    [(b"Ham", "Ham"), ("é".encode(), "é"), (b"", ""), (b"Ham\0junk", "Ham"), ("日本".encode(), "日本"),
     (b"A\xc3", "A�"), (b"x" * 32, "x" * 32)],
)
def test_name_stops_at_nul(spark, data, expected):
    assert one(spark, packets.name_text(codes(data))) == expected


def test_name_raw_is_the_code_list(spark):
    assert one(spark, packets.name_raw(F.array(F.lit(72), F.lit(0)))) == "[72, 0]"


HEADERS = "array<struct<key:string,value:binary>>"


@pytest.mark.parametrize(
    "headers, expected",
    [(None, None), ([], None), ([("other", b"x")], None),
     ([("other", b"x"), ("traceparent", b"t1"), ("traceparent", b"t2")], "t1"),
     ([("traceparent", None)], None)],
)
def test_trace_header(spark, headers, expected):
    rows = spark.createDataFrame([(headers,)], f"h {HEADERS}")
    assert rows.select(traces.from_headers(F.col("h"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, valid, ids_",
    [("00-a-b-01", True, ("a", "b")), ("bad", False, None), ("1-2-3-4-5", False, None),
     ("00-a-b-", False, None), ("00-a-b-01--", True, ("a", "b")), ("-a-b-01", True, ("a", "b")), ("", False, None)],
)
def test_trace_parts(spark, text, valid, ids_):
    assert one(spark, traces.is_valid(F.lit(text))) is valid
    if valid:
        assert (one(spark, traces.trace_id(F.lit(text))), one(spark, traces.span_id(F.lit(text)))) == ids_
    else:
        with pytest.raises(Exception, match="invalid traceparent format"):
            one(spark, traces.require_valid(F.lit(text)))


def test_trace_make(spark):
    assert one(spark, traces.make(F.lit("t"), F.lit("s"))) == "00-t-s-01"


@pytest.mark.parametrize(
    "seconds, expected",
    [(None, "--:--:--"), (0.0, "00:00:00"), (59.9, "00:00:59"), (3661.0, "01:01:01"), (360000.0, "100:00:00")],
)
def test_session_clock(spark, seconds, expected):
    assert one(spark, display.session_clock(F.lit(seconds).cast("float"))) == expected


def test_epoch_ms(spark):
    assert one(spark, display.epoch_ms(F.lit("2025-01-01T00:00:01.250Z"))) == 1735689601250
    assert one(spark, display.epoch_ms(F.lit("soon"))) is None
