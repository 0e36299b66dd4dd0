"""Scalar column functions shared by the operators."""

from .numeric import fahrenheit_to_celsius, half_up, percent
from .text import NULL_CLASS, seeded_hash, slug
from .time import completed_years, elapsed_days

__all__ = [
    "NULL_CLASS", "completed_years", "elapsed_days", "fahrenheit_to_celsius",
    "half_up", "percent", "seeded_hash", "slug",
]
