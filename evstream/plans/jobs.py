"""The analytics jobs, as compositions of operators over tables.

Every job takes event-time columns by name and its parameters as arguments. The jobs whose
shape a stream accepts as it stands also run on streams; the others have a streaming form in
:mod:`evstream.streaming.jobs`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evstream.functions.time import micros
from evstream.operators import alerts, joins, late, patterns, running, windows
from evstream.operators.common import cents, from_cents


def hot_keys(
    df: DataFrame, ts: str, key: str, size: str, slide: str, n: int
) -> DataFrame:
    """The ``n`` most frequent values of ``key`` per sliding window, ties by value."""
    counts = windows.slide(df, ts, size, slide, [key]).drop("window_start")
    return windows.top_n(counts, ["window_end"], [F.desc("cnt"), F.asc(key)], n)


def page_views(df: DataFrame, ts: str, size: str = "1 hour") -> DataFrame:
    return windows.tumble(df, ts, size, [], F.count(F.lit(1)).alias("pv"))


def unique_visitors(df: DataFrame, ts: str, user: str, size: str = "1 hour") -> DataFrame:
    return windows.distinct_per_window(df, ts, size, user).select("window_end", "uv")


def unique_visitors_bitmap(
    df: DataFrame, ts: str, user: str, order: Sequence[str], size: str = "1 hour"
) -> DataFrame:
    """The running bitmap estimate, one row per view."""
    return running.bitmap_distinct_running(df, ts, size, user, order)


def marketing(
    df: DataFrame, ts: str, size: str, slide: str, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per channel and behaviour, or with ``by`` empty the total under fixed labels."""
    out = windows.slide(df, ts, size, slide, list(by))
    if not by:
        out = out.withColumns({"channel": F.lit("app marketing"), "behavior": F.lit("total")})
    return out


def ad_clicks(df: DataFrame, keys: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """Clicks with click farming removed (``pass``) and one ``warn`` per key and day."""
    return alerts.daily_cap(df, keys, order, cap)


def black_list(capped: DataFrame, keys: Sequence[str], ts: str, cap: int) -> DataFrame:
    return capped.where(F.col("tag") == "warn").select(
        *keys, F.to_date(ts).alias("day"), F.lit(f"Click over {cap} times today.").alias("msg")
    )


def clicks_by_province(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cap: int, province: str, size: str, slide: str
) -> DataFrame:
    clean = ad_clicks(df, keys, order, cap).where(F.col("tag") == "pass")
    return windows.slide(clean, order[0], size, slide, [province]).drop("window_start")


def login_failures(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, within: str
) -> DataFrame:
    out = alerts.repeated_failure(df, keys, order, failed, within)
    return out.withColumn("msg", F.lit(f"login fail in {within}."))


def login_failures_pattern(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, within: str
) -> DataFrame:
    steps = [patterns.Step("first", failed), patterns.Step("second", failed, strict=True)]
    found = patterns.match_sequence(df, keys, order, steps, within)
    return found.where(F.col("tag") == patterns.MATCH).select(
        *keys,
        F.col(f"first.{order[0]}").alias("first_fail_time"),
        F.col(f"second.{order[0]}").alias("last_fail_time"),
        F.lit(f"login fail in {within}.").alias("msg"),
    )


def order_payment_pattern(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], created: Column, paid: Column, limit: str
) -> DataFrame:
    """Creates paid in time (``match``) and those that ran out of time (``timeout``)."""
    steps = [patterns.Step("create", created), patterns.Step("pay", paid)]
    found = patterns.match_sequence(df, keys, order, steps, limit)
    return found.select(
        *keys,
        F.col(f"create.{order[0]}").alias("create_time"),
        F.when(F.col("tag") == patterns.MATCH, F.col(f"pay.{order[0]}")).alias("pay_time"),
        "tag",
    )


def payment_matching(
    pays: DataFrame, receipts: DataFrame, on: Sequence[tuple[str, str]], pay_ts: str, receipt_ts: str, wait: str
) -> DataFrame:
    return joins.match_within(pays, receipts, on, pay_ts, receipt_ts, wait)


def payment_join(
    pays: DataFrame, receipts: DataFrame, on: Sequence[tuple[str, str]], pay_ts: str, receipt_ts: str, wait: str
) -> DataFrame:
    return joins.interval_join(pays, receipts, on, pay_ts, receipt_ts, f"{-micros(wait)} microseconds", wait)


def sales_by_category(
    df: DataFrame, ts: str, category: str, price: str, utc_offset: str = "8 hours"
) -> DataFrame:
    """Sales per category and local day, in whole cents."""
    return windows.tumble(
        df, ts, "1 day", [category], F.sum(cents(price)).alias("cents"), offset=f"{-micros(utc_offset)} microseconds"
    )


def sales_dashboard(by_category: DataFrame, category: str, n: int = 3) -> DataFrame:
    """The ``n`` best categories of a day beside the day's total."""
    totals = by_category.groupBy("window_start").agg(F.sum("cents").alias("day_cents"))
    best = windows.top_n(by_category, ["window_start"], [F.desc("cents"), F.asc(category)], n)
    return best.join(totals, "window_start").select(
        F.col("window_start").alias("day"),
        "rank",
        category,
        from_cents("cents").alias("total_price"),
        from_cents("day_cents").alias("total"),
    )


def smallest_value(df: DataFrame, ts: str, key: str, value: str, size: str) -> DataFrame:
    return windows.tumble(df, ts, size, [key], F.min(value).alias("min_value"))


def totals_with_late_rows(
    df: DataFrame, ts: str, arrival: str, bound: str, window: str, lateness: str
) -> DataFrame:
    return late.split_late(df, ts, arrival, bound, window, lateness)


def channel_starts(df: DataFrame, ts: str, channel: str, wanted: str, size: str = "10 seconds") -> DataFrame:
    """Starts per channel and window, for one store."""
    wanted_rows = df.where(F.col(channel) == wanted)
    return windows.tumble(wanted_rows, ts, size, [channel], F.count(F.lit(1)).alias("cnt"))


def forward_json(df: DataFrame, keep: Column, *cols: str) -> DataFrame:
    """Rows that pass a filter, as JSON documents."""
    return df.where(keep).select(F.to_json(F.struct(*cols)).alias("value"))
