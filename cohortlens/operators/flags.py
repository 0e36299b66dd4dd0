"""Code-prefix flags per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..specs import CodeFlag


def matches(prefix: Column, flag: CodeFlag) -> Column:
    """Text comparison on the prefix; codes are never cast to numbers."""
    return reduce(lambda a, b: a | b, (prefix.between(low, high) for low, high in flag.spans))


def code_flags(codes: DataFrame, key: str, code: str, flags: Sequence[CodeFlag], width: int = 3) -> DataFrame:
    """One row per key with a 0/1 column per flag; a key without any match gets zeros."""
    prefix = F.left(F.col(code), F.lit(width))
    return codes.groupBy(key).agg(
        *[F.max(F.when(matches(prefix, f), 1).otherwise(0)).cast("short").alias(f.name) for f in flags]
    )
