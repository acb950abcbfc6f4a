"""Session ids and record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_63 = 2**63
_TWO_64 = 2**64


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def signed_uid(unsigned: Column) -> Column:
    """Unsigned 64-bit id, held as DECIMAL(20,0), wrapped to a signed BIGINT."""
    return (
        F.when(unsigned >= _decimal(_TWO_63), unsigned - _decimal(_TWO_64))
        .otherwise(unsigned)
        .cast("bigint")
    )


def unsigned_uid(signed: Column) -> Column:
    """The inverse of :func:`signed_uid`, as DECIMAL(20,0)."""
    wide = signed.cast("decimal(20,0)")
    return F.when(signed < 0, wide + _decimal(_TWO_64)).otherwise(wide).cast("decimal(20,0)")


def packet_key(signed: Column) -> Column:
    """Record key of a published packet: ``session_`` and the unsigned id."""
    return F.concat(F.lit("session_"), unsigned_uid(signed).cast("string"))


def feed_key(signed: Column) -> Column:
    """Record key of an aggregate feed: the bare signed id."""
    return signed.cast("string")
