"""One-hash bitmap offsets for approximate distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Multiplier and bitmap size (bits) of the visitor bitmap.
BITMAP_SEED = 61
BITMAP_BITS = 1 << 29


def bitmap_offset(value, seed: int = BITMAP_SEED, bits: int = BITMAP_BITS) -> Column:
    """Bit number of a string in a power-of-two bitmap: ``h = h * seed + char``, masked.

    Masking at every step keeps the low bits of the unmasked sum and never overflows.
    """
    if bits & (bits - 1):
        raise ValueError("bits must be a power of two")
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    step = lambda acc, i: (acc * F.lit(seed) + F.ascii(F.substr(text, i, F.lit(1)))).bitwiseAND(
        F.lit(bits - 1)
    )
    positions = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(positions, F.lit(0).cast("bigint"), step)
