"""Wide-table assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def assemble(
    base: DataFrame,
    parts: Sequence[tuple[str, DataFrame]],
    columns: Sequence[str],
    fill: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left-join feature tables, each unique on its key, to the base and project ``columns``.

    Parts with the same key should stand next to each other so the base is shuffled once for them.
    ``fill`` replaces NULLs (also those of unmatched rows) while keeping the column's type.
    """
    wide = base
    for key, part in parts:
        wide = wide.join(part, key, "left")
    types = dict(wide.dtypes)
    fill = fill or {}
    return wide.select(
        *[
            F.coalesce(F.col(c), F.lit(fill[c]).cast(types[c])).alias(c) if c in fill else F.col(c)
            for c in columns
        ]
    )
