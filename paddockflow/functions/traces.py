"""W3C trace parents: ``00-<trace id>-<span id>-01``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_KEY = "traceparent"


def from_headers(headers: Column) -> Column:
    """First record header named ``traceparent`` as text, NULL when there is none."""
    matches = F.filter(headers, lambda header: header["key"] == HEADER_KEY)
    return F.get(matches, F.lit(0))["value"].cast("string")


def make(trace_id: Column, span_id: Column) -> Column:
    return F.concat_ws("-", F.lit("00"), trace_id, span_id, F.lit("01"))


def to_headers(trace_parent: Column) -> Column:
    """Header array with the one trace parent, as the record source delivers it."""
    return F.array(
        F.struct(
            F.lit(HEADER_KEY).alias("key"),
            trace_parent.cast("binary").alias("value"),
        )
    )


def parts(trace_parent: Column) -> Column:
    """Dash-separated parts; dashes at the end do not open further parts."""
    return F.split(F.regexp_replace(trace_parent, "-+$", ""), "-")


def is_valid(trace_parent: Column) -> Column:
    return F.size(parts(trace_parent)) == 4


def trace_id(trace_parent: Column) -> Column:
    return F.get(parts(trace_parent), F.lit(1))


def span_id(trace_parent: Column) -> Column:
    return F.get(parts(trace_parent), F.lit(2))


def require_valid(trace_parent: Column) -> Column:
    """The trace parent itself; any that has not four parts fails the job."""
    return F.when(
        trace_parent.isNull() | is_valid(trace_parent), trace_parent
    ).otherwise(F.raise_error(F.concat(F.lit("invalid traceparent format: "), trace_parent)))
