from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_up(value: Column, scale: int) -> Column:
    """Round half away from zero, as SQL does on exact decimals; the result is a double.

    The detour over a ten-digit decimal removes the binary noise of an average, so 80.475 rounds
    to 80.48 in every engine.
    """
    return F.round(value.cast("decimal(28,10)"), scale).cast("double")


def percent(part: Column, whole: Column, scale: int) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return half_up(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), scale)


def fahrenheit_to_celsius(value: Column) -> Column:
    return (value - 32.0) * 5.0 / 9.0
