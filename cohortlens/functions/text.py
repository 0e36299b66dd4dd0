from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The class a missing value gets when a text column is label-encoded.
NULL_CLASS = "nan"

HASH_SPACE = 1 << 32


def seeded_hash(seed: int, *ids: str) -> Column:
    """A reproducible pseudo-random integer in [0, 2**32) for a row identifier."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in ids], F.lit(seed)), F.lit(HASH_SPACE))


def slug(name: str) -> str:
    """A name for files: lower-case letters and digits, one underscore for every run of anything else between them."""
    return re.sub(r"[\W_]+", "_", name.lower()).strip("_")
