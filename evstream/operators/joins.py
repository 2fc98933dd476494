"""Interval joins and two-sided matching on equal keys and near times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from evstream.functions.time import epoch_us, floor_div, interval, micros

BUCKET = "_bucket"
PAIR, LEFT_ONLY, RIGHT_ONLY = "match", "left_only", "right_only"


def interval_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_ts: str, right_ts: str,
    lower: str, upper: str, how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and right time in ``[left + lower, left + upper]``.

    On tables both sides carry the number of a time bucket as wide as the interval, and one side
    is copied to the (at most two) buckets its partners can lie in. The join is then an equi-join
    on key and bucket: a hot key is spread over its buckets. Streams join on key and time, which
    Spark needs for clearing its state. ``how``: ``inner``, ``left`` or ``left_anti``.
    """
    if left.isStreaming or right.isStreaming:
        return _stream_join(left, right, on, left_ts, right_ts, lower, upper, how)
    lo, hi = micros(lower), micros(upper)
    width = max(hi - lo, 1_000_000)
    spread = _buckets(right, right_ts, -hi, -lo, width)
    single = left.withColumn(BUCKET, floor_div(epoch_us(left_ts), width))
    cond = _equal(single, spread, on) & (single[BUCKET] == spread[BUCKET])
    cond &= _near(single[left_ts], spread[right_ts], lo, hi)
    joined = single.join(spread, cond, how)
    return joined.drop(single[BUCKET]).drop(spread[BUCKET]) if how != "left_anti" else joined.drop(BUCKET)


def _stream_join(left, right, on, left_ts, right_ts, lower, upper, how):
    # In outer joins of streams, Spark takes a NULL key for equal to another: keep sides apart.
    left = left.withColumn("_null_l", _some_null(left, [l for l, _ in on], 1))
    right = right.withColumn("_null_r", _some_null(right, [r for _, r in on], 2))
    cond = (left["_null_l"] == right["_null_r"]) & _equal(left, right, on) & right[right_ts].between(
        left[left_ts] + interval(lower), left[left_ts] + interval(upper)
    )
    return left.join(right, cond, how).drop("_null_l", "_null_r")


def _some_null(df: DataFrame, columns: Sequence[str], mark: int) -> Column:
    return F.when(reduce(lambda a, b: a | b, [df[c].isNull() for c in columns]), mark).otherwise(0)


def _buckets(df: DataFrame, ts: str, lo: int, hi: int, width: int) -> DataFrame:
    us = epoch_us(ts)
    first, last = floor_div(us + F.lit(lo), width), floor_div(us + F.lit(hi), width)
    return df.withColumn(BUCKET, F.explode(F.sequence(first, last)))


def _equal(left: DataFrame, right: DataFrame, on) -> Column:
    return reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in on])


def _near(left_ts: Column, right_ts: Column, lo: int, hi: int) -> Column:
    return (epoch_us(right_ts) - epoch_us(left_ts)).between(lo, hi)


def match_by_id(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_ts: str, right_ts: str, wait: str
) -> DataFrame:
    """As :func:`match_within` for ids that occur once on a side: one outer join, so each side is
    shuffled once and gives one row at most. Rows of one id farther apart than ``wait``, and
    those without an id, stand alone; the latter are dealt to all tasks."""
    if left.isStreaming or right.isStreaming:
        return match_within(left, right, on, left_ts, right_ts, wait)
    span = micros(wait)
    a = _dealt(left.withColumn("_left", F.lit(True)), [l for l, _ in on], 1, "_deal_l")
    b = _dealt(right.withColumn("_right", F.lit(True)), [r for _, r in on], -1, "_deal_r")
    both = a.join(b, (a["_deal_l"] == b["_deal_r"]) & _equal(a, b, on) & _near(a[left_ts], b[right_ts], -span, span), "full_outer")
    tag = F.when(F.col("_right").isNull(), LEFT_ONLY).when(F.col("_left").isNull(), RIGHT_ONLY).otherwise(PAIR)
    return both.withColumn("tag", tag).drop("_left", "_right", "_deal_l", "_deal_r")


def _dealt(df: DataFrame, columns: Sequence[str], sign: int, out: str) -> DataFrame:
    """A further join key: 0 for rows with an id, and for the others, which match nothing, numbers
    that spread them and that the other side does not have."""
    deal = F.monotonically_increasing_id() % 65_536 + 1
    return df.withColumn(out, F.when(_some_null(df, columns, 1) == 1, deal * sign).otherwise(F.lit(0).cast("bigint")))


def match_within(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_ts: str, right_ts: str,
    wait: str,
) -> DataFrame:
    """Two-sided match with a waiting time: pairs at most ``wait`` apart, and from each side the
    rows that found no partner, told apart by ``tag``."""
    back = f"{-micros(wait)} microseconds"
    there = f"{micros(wait)} microseconds"
    if left.isStreaming or right.isStreaming:
        both = _stream_join(left, right, on, left_ts, right_ts, back, there, "full_outer")
        # By the times: a key may be NULL on a row that is there.
        left_key, right_key = left[left_ts], right[right_ts]
        return both.withColumn(
            "tag", F.when(right_key.isNull(), LEFT_ONLY).when(left_key.isNull(), RIGHT_ONLY).otherwise(PAIR)
        )
    paired = interval_join(left, right, on, left_ts, right_ts, back, there, "left")
    paired = paired.withColumn("tag", F.when(F.col(right_ts).isNull(), LEFT_ONLY).otherwise(PAIR))
    flipped = [(r, l) for l, r in on]
    alone = interval_join(right, left, flipped, right_ts, left_ts, back, there, "left_anti")
    return paired.unionByName(alone.withColumn("tag", F.lit(RIGHT_ONLY)), allowMissingColumns=True)
