"""A Bloom filter of keys, as a table of bitmaps: most rows without a partner go before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bits of the filter. A bitmap of Spark's holds 32,768 of them in 4 KB, so the whole filter is 8 MB at most;
# more keys than bits make it useless, never wrong.
BITS = 1 << 26
BITMAP_BITS = 1 << 15
WORD_BITS = 64


def with_known_keys(rows: DataFrame, keyed: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows whose ``key`` may occur in ``keyed``, in place and without those whose key surely does not.

    ``keyed`` is read once more for its keys, so store it first. Rows with a null key go: they have no
    partner. At most ``bits / BITMAP_BITS`` bitmaps of 4 KB are broadcast, whatever the number of keys.
    """
    known = (
        keyed.where(F.col(key).isNotNull()).select(_place(key, bits).alias("_key_place"))
        .groupBy(F.bitmap_bucket_number("_key_place").alias("_key_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_key_place")).alias("_key_bits"))
        .select("_key_bucket", F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // WORD_BITS - 1)), _word).alias("_key_words"))
    )
    placed = rows.where(F.col(key).isNotNull()).withColumn("_key_place", _place(key, bits))
    placed = placed.withColumn("_key_bucket", F.bitmap_bucket_number("_key_place"))
    bit = F.bitmap_bit_position("_key_place")
    word = F.get("_key_words", F.shiftright(bit, 6).cast("int"))
    # A word's first byte is its highest, the first bit of a byte its lowest.
    held = F.call_function("bit_get", word, (bit % WORD_BITS).bitwiseXOR(WORD_BITS - 8).cast("int")) == 1
    return placed.join(F.broadcast(known), "_key_bucket").where(held).select(*rows.columns)


def _word(place: Column) -> Column:
    """Eight bytes of a bitmap as a long, made once a bitmap: a row then takes a bit of a number instead of cutting
    a byte out of four thousand and reading it as text."""
    size = WORD_BITS // 8
    return F.conv(F.hex(F.substring(F.col("_key_bits"), place * size + 1, F.lit(size))), 16, -10).cast("long")


def _place(key: str, bits: int) -> Column:
    """The bit of a key, counted from 1."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1
