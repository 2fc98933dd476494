"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from evstream.session import BROADCAST_BYTES, BROADCAST_BYTES_DEFAULT, int_setting

ROW_OVERHEAD = 32


def key_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", rows: int | None = None
) -> DataFrame:
    """Join on equal keys, null equal to null, keeping the left side's keys.

    ``rows`` is the measured number of rows of the right side (of elements, where it holds
    arrays), if known: a small one is broadcast.
    """
    # New key names on the right: both sides may come from the same table.
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if rows is not None:
        renamed = broadcast_if_small(renamed, rows)
    equal = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, equal, how).drop(*[f"_r_{k}" for k in keys])


def broadcast_if_small(small: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table whose rows were counted and have a fixed width, if rows times width is
    small. Texts have no such bound: their join is left to Spark, which weighs what it has read."""
    limit = int_setting(small.sparkSession, BROADCAST_BYTES, BROADCAST_BYTES_DEFAULT)
    width = fixed_width(small.schema)
    return F.broadcast(small) if width is not None and rows * (width + ROW_OVERHEAD) <= limit else small


def fixed_width(kind: T.DataType) -> int | None:
    """Bytes of a value (of an element, for arrays), or None where values differ in width."""
    if isinstance(kind, T.StructType):
        widths = [fixed_width(f.dataType) for f in kind.fields]
        return None if None in widths else 8 + sum(widths)
    if isinstance(kind, T.ArrayType):
        return fixed_width(kind.elementType)
    if isinstance(kind, (T.StringType, T.BinaryType, T.MapType)):
        return None
    return 16 if isinstance(kind, T.DecimalType) else 8


def cents(col) -> Column:
    """Two-decimal money as whole cents: sums are exact and independent of row order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("bigint")


def from_cents(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double") / F.lit(100.0)
