"""The run's clock and the rounding rules of assignments to narrower types."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = int | float | datetime | Column


def epoch_seconds(instant: Instant) -> Column:
    """Seconds since 1970 with the fraction kept; a timestamp Column is converted."""
    if isinstance(instant, Column):
        return F.unix_micros(instant) / F.lit(1e6)
    if isinstance(instant, datetime):
        if instant.tzinfo is None:
            instant = instant.replace(tzinfo=timezone.utc)
        instant = instant.timestamp()
    return F.lit(float(instant))


def window_start(as_of: Instant, seconds: int) -> Column:
    """Start of the trailing window as BIGINT: rounded, not truncated."""
    return F.round(epoch_seconds(as_of) - F.lit(seconds)).cast("bigint")


def half_even_int(c: Column) -> Column:
    """DOUBLE to INT as on assignment: halves go to the even neighbour."""
    return F.bround(c, 0).cast("int")
