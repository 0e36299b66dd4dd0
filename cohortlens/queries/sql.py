"""Pieces of SQL text shared by the counterparts."""

from __future__ import annotations

from collections.abc import Sequence

from ..specs import CodeFlag, Measure


def rounded(expr: str, scale: int) -> str:
    return f"CAST(round(CAST({expr} AS decimal(28,10)), {scale}) AS double)"


def literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def averages(measures: Sequence[Measure], code: str, value: str) -> str:
    """Select-list of range-clipped conditional averages."""
    parts = []
    for m in measures:
        codes = ", ".join(literal(c) for c in m.codes)
        inside = f"CASE WHEN {code} IN ({codes}) AND {value} BETWEEN {m.low} AND {m.high} THEN {value} END"
        parts.append(f"{rounded(f'avg({inside})', m.scale)} AS {m.name}")
    return ", ".join(parts)


def code_list(measures: Sequence[Measure]) -> str:
    return ", ".join(literal(c) for m in measures for c in m.codes)


def flags(specs: Sequence[CodeFlag], code: str) -> str:
    """Select-list of prefix flags."""
    parts = []
    for f in specs:
        tests = " OR ".join(f"left({code}, 3) BETWEEN '{low}' AND '{high}'" for low, high in f.spans)
        parts.append(f"CAST(max(CASE WHEN {tests} THEN 1 ELSE 0 END) AS smallint) AS {f.name}")
    return ", ".join(parts)


# The pseudo-random number used by queries that must draw the same rows in both engines.
def number(row_id: str) -> str:
    return f"(({row_id} % 2147483648) * 2654435761) % 4294967296"
