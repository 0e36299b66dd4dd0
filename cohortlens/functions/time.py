from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def completed_years(born: Column, at: Column) -> Column:
    """Whole years between two timestamps; the time of day counts towards completion."""
    return F.timestamp_diff("YEAR", born, at)


def elapsed_days(start: Column, end: Column, scale: int) -> Column:
    """Fractional days rounded half up, computed on exact microseconds."""
    micros = F.timestamp_diff("MICROSECOND", start, end).cast("decimal(20,0)")
    return F.round(micros / F.lit(MICROS_PER_DAY), scale)
