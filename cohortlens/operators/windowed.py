"""Averages of long event tables inside a bounded time window per entity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import half_up
from ..specs import WINDOW_HOURS, Measure
from .keyed import with_known_keys

MICROS_PER_HOUR = 3_600_000_000


def windowed_averages(
    events: DataFrame,
    windows: DataFrame,
    key: str,
    code: str,
    at: str,
    value: str,
    start: str,
    measures: Sequence[Measure],
    hours: int = WINDOW_HOURS,
    convert: Callable[[Column, Column], Column] | None = None,
    valid: Column | None = None,
    stored_windows: bool = False,
) -> DataFrame:
    """One row per key with the rounded average of each measure in [start, start + hours].

    Only positive raw values count; ``convert(code, value)`` runs before the range check. A key
    with events but none plausible gets a row of NULLs, a key without events gets no row.

    Time is cut into slots as long as the window, so a window touches two slots and each event one.
    Joining on (key, slot) is exact, keeps the two bounds as a cheap residual test, drops events far
    from any window early, and spreads a key with very many events. The sums are combined per task
    before they are shuffled by key. With ``stored_windows``, which says that reading the windows again
    is cheap, a Bloom filter of their keys keeps the events of other keys out of the shuffle.
    """
    wanted = sorted({c for m in measures for c in m.codes})
    raw = events.where(F.col(code).isin(wanted) & (F.col(value) > 0))
    if valid is not None:
        raw = raw.where(valid)
    converted = F.col(value) if convert is None else convert(F.col(code), F.col(value))
    readings = raw.select(
        F.col(key), F.col(code).alias("_code"), F.col(at).alias("_at"),
        converted.alias("_value"), _slot(F.col(at), hours).alias("_slot"),
    )
    if stored_windows:
        readings = with_known_keys(readings, windows, key)
    # Copies of one window are carried as a weight instead of multiplying the events.
    spans = (
        windows.groupBy(key, F.col(start).alias("_start")).agg(F.count("*").alias("_copies"))
        .withColumn("_end", F.col("_start") + F.expr(f"INTERVAL '{hours}' HOUR"))
        .withColumn("_slot", F.explode(F.sequence(_slot(F.col("_start"), hours), _slot(F.col("_end"), hours))))
    )
    inside = readings.join(spans, [key, "_slot"]).where(F.col("_at").between(F.col("_start"), F.col("_end")))
    return inside.groupBy(key).agg(*[_average(m) for m in measures])


def _slot(at: Column, hours: int) -> Column:
    return F.call_function("div", F.unix_micros(at.cast("timestamp")), F.lit(hours * MICROS_PER_HOUR))


def _average(m: Measure) -> Column:
    usable = F.col("_code").isin(list(m.codes)) & F.col("_value").between(m.low, m.high)
    total = F.sum(F.when(usable, F.col("_value") * F.col("_copies")))
    return half_up(total / F.sum(F.when(usable, F.col("_copies"))), m.scale).alias(m.name)
