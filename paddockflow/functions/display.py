"""Values as a dashboard shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_CLOCK = "--:--:--"


def session_clock(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS``, rounded down; hours grow past two digits."""
    whole = F.floor(seconds).cast("bigint")
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(whole / 3600).cast("bigint"),
        F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("bigint"),
        F.pmod(whole, F.lit(60)),
    )
    return F.when(seconds.isNull(), NO_CLOCK).otherwise(text)


def epoch_ms(iso_text: Column) -> Column:
    """ISO timestamp text as epoch milliseconds, NULL when it is no timestamp."""
    return F.unix_millis(F.try_to_timestamp(iso_text))
