"""Columns read out of a decoded packet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000


def element(cars: Column, index: Column) -> Column:
    """Array element, NULL when the index lies outside the array (255, for one)."""
    return F.get(cars, index)


def player(cars: str, field: str) -> Column:
    """A field of the player's own car, picked by the header's car index."""
    return element(F.col(cars), F.col("m_header.m_player_car_index"))[field]


def split_ms(minutes: Column, ms_part: Column) -> Column:
    """Split time sent as whole minutes plus milliseconds, as BIGINT milliseconds."""
    return minutes.cast("bigint") * F.lit(MS_PER_MINUTE).cast("bigint") + ms_part


def name_text(codes: Column) -> Column:
    """Byte codes up to the first NUL as UTF-8 text.

    Bytes that are no valid UTF-8 (a name cut at 32 bytes can end inside a
    character) become U+FFFD rather than failing the job.
    """
    pairs = F.transform(codes, lambda code: F.lpad(F.hex(code.bitwiseAND(F.lit(255))), 2, "0"))
    text = F.make_valid_utf8(F.unhex(F.array_join(pairs, "")).cast("string"))
    return F.substring_index(text, "\x00", 1)


def name_raw(codes: Column) -> Column:
    """The bracketed list of codes, which is all a plain string cast yields."""
    return codes.cast("string")
