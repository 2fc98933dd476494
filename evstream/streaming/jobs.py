"""Streaming forms of the jobs and operators whose table form a stream does not accept.

Inputs are streaming DataFrames. Event-time columns must be ``timestamp`` for a watermark, so
:func:`event_time` converts the time-zone-free ones and keeps microseconds in ``_us``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from evstream.functions.hashing import bitmap_offset
from evstream.functions.time import epoch_us, floor_div, from_epoch_us, micros, tumbling
from evstream.operators import joins, windows
from evstream.operators.late import DROPPED, ON_TIME, REFIRE, with_watermark
from evstream.operators.patterns import Step
from evstream.streaming import packs, processors as p

US = "_us"
EVENT_TIME, PROCESSING_TIME, BY_ARRIVAL = "eventTime", "processingTime", "none"
# Rows at or past this time are no data: they tell a bounded stream that its input has ended.
END = dt.datetime(9000, 1, 1)


def event_time(df: DataFrame, ts: str, bound: str = "0 seconds") -> DataFrame:
    """Declare event time and watermark, with the time also as a number in ``_us``."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withColumn(US, epoch_us(ts))
    return _before_end(with_watermark(timed, ts, bound), ts)


def _before_end(df: DataFrame, ts: str) -> DataFrame:
    """Leave closing rows out, once they have moved the watermark of ``ts``."""
    return df.where(F.col(ts).isNull() | (F.col(ts) < F.lit(END)))


def plain_times(df: DataFrame) -> DataFrame:
    """Time columns without a zone, as the table forms give them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _process(df, keys, processor, out: list[T.StructField], mode: str) -> DataFrame:
    schema = T.StructType(_fields(df, *keys) + out)
    processor.columns = tuple(schema.fieldNames())
    return df.groupBy(*keys).transformWithState(processor, schema, "append", mode)


def _ordered(df, keys, processor_cls, order, carried, out, **args) -> DataFrame:
    """Run an event-order processor over ``carried`` columns; ``order`` follows ``_us``. Rows
    without an event time have no place in the order and take no part."""
    needed = [US, *order, *[c for c in carried if c not in order]]
    fields = T.StructType(_fields(df, *needed))
    ts = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    slim = df.where(F.col(US).isNotNull()).select(*keys, *ts, *[c for c in needed if c not in keys])
    return _process(slim, keys, processor_cls(fields, [US, *order], **args), out, EVENT_TIME)


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


# --- windows -------------------------------------------------------------------------------


def unique_visitors(df: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Exact distinct count per window: first one row per window and user, then a count."""
    users = df.groupBy(F.window(ts, size).alias("w"), F.col(user)).agg(F.count(F.lit(1)).alias("n"))
    per_window = users.groupBy(F.window("w", size).alias("w")).agg(F.count(F.lit(1)).alias("uv"))
    return plain_times(per_window.select(F.col("w.end").alias("window_end"), "uv"))


def _best(df: DataFrame, keys: Sequence[str], item: str, n: int, again: str | None = None) -> DataFrame:
    fields, late = [*_fields(df, item), T.StructField("cnt", T.LongType())], T.StructField("_late", T.BooleanType())
    best = p.BestOfWindow(n, item, "cnt", T.StructType(fields), None if again is None else micros(again), "_late")
    out = [*_long("firing"), T.StructField("rank", T.IntegerType()), *fields, late]
    return _process(df.select(*keys, item, "cnt", "_late"), keys, best, out, EVENT_TIME)


def _best_in_lanes(counts: DataFrame, item: str, n: int, lanes: int, again: str | None = None) -> DataFrame:
    """``_e, firing, rank, item, cnt``: the best of each of ``lanes`` groups of items first, by many
    tasks, then the best of those few."""
    lane = F.pmod(F.hash(item), F.lit(lanes)).alias("_lane")
    few = _best(counts.select("_e", lane, item, "cnt", "_late"), ["_e", "_lane"], item, n, again)
    return _best(few, ["_e"], item, n, again).drop("_late")


def _best_of_tasks(counts: DataFrame, group: Sequence[str], item: str, n: int) -> DataFrame:
    """``counts`` cut to the ``n`` best of each group in what a task gathers: no other can be among the
    best of all. Rows without an item or a count have no rank."""
    group = list(group)

    def best(t: pa.Table) -> pa.Table:
        t = t.group_by([*group, item], use_threads=False).aggregate([("cnt", "max")])
        t = t.rename_columns([*t.column_names[:-1], "cnt"]).sort_by([("cnt", "descending"), (item, "ascending")])
        _, order, at = packs.grouped(t, group)
        rank = np.arange(len(order)) - np.repeat(at[:-1], np.diff(at))
        return t.take(pa.array(order[rank < n]))

    return packs.reduced(counts.where(F.col(item).isNotNull() & F.col("cnt").isNotNull()).select(*group, item, "cnt"), best)


def hot_keys(df: DataFrame, ts: str, key: str, size: str, slide: str, n: int, lanes: int = 256) -> DataFrame:
    """Top ``n`` per sliding window, put out when the window closes, ties to the smaller key.

    A state row holds ``n`` keys, whatever the number of keys in a window: they are ranked in
    ``lanes`` groups first, and the few best of each group are ranked again.
    """
    counts = _slide_counts(df, ts, size, slide, [key]).select(
        epoch_us("w.end").alias("_e"), key, "cnt", F.lit(False).alias("_late"))
    best = _best_in_lanes(counts, key, n, lanes)
    return best.select(from_epoch_us("_e").alias("window_end"), "rank", key, "cnt")


def refiring_totals(
    df: DataFrame, ts: str, keys: Sequence[str], value: Column, bound: str, window: str, lateness: str, out: str = "total",
    shares: int = 8,
) -> DataFrame:
    """Sums of whole numbers per key and tumbling window that late rows correct: a row when the
    watermark (``bound`` behind the latest time) passes the window's end, ``firing`` 1, and one after
    every micro-batch with rows for it, until it is ``lateness`` past. Later rows are left out, as
    are those without an event time. The last firing of a window is the last word on it.

    The keys of a window are dealt to ``shares``, each one entry of the state and its totals in memory at a
    time; rows are summed up in their tasks first.
    """
    keys, width = list(keys), micros(window)
    timed = with_watermark(df.withColumn(ts, F.col(ts).cast("timestamp")), ts, bound)
    timed = _before_end(timed, ts).where(F.col(ts).isNotNull())
    share = (F.pmod(F.hash(*keys), F.lit(shares)) if keys else F.lit(0)).alias("_share")
    # Without the event-time column Spark does not look for late rows itself.
    slim = timed.select(share, ((floor_div(epoch_us(ts), width) + 1) * width).alias("_e"), *keys, value.cast("bigint").alias("_v"))
    group = ["_share", "_e"]
    parts = packs.packed(slim, group, [*keys, "_v"], lambda t: packs.sums(t, [*group, *keys], "_v"))
    told = _process(
        parts, group, p.RefiringWindow(keys, "_v", micros(lateness)), [T.StructField(packs.ROWS, T.BinaryType())], EVENT_TIME)
    late = T.StructField("_late", T.BooleanType())
    fired = packs.unpacked(told, ["_e"], [*_fields(df, *keys), *_long("_firing", "_v"), late])
    return fired.select(
        *keys, from_epoch_us(F.col("_e") - width).alias("window_start"), from_epoch_us("_e").alias("window_end"),
        F.col("_firing").alias("firing"), F.col("_v").alias(out), F.col("_late").alias("late"))


def refiring_top(
    df: DataFrame, ts: str, key: str, bound: str, window: str, lateness: str, n: int, value: Column | None = None,
    lanes: int = 256, shares: int = 8,
) -> DataFrame:
    """``window_end, firing, rank, key, cnt``: the top ``n`` of each window as it closes, and the whole
    ranking anew after every micro-batch with late rows for it. Counts, or sums of a ``value`` that is
    never negative. Totals are cut to the best in their tasks before they are ranked."""
    counts = refiring_totals(df, ts, [key], F.lit(1) if value is None else value, bound, window, lateness, "cnt", shares)
    counts = counts.select(epoch_us("window_end").alias("_e"), key, "cnt", F.col("late").alias("_late"))
    best = _best_in_lanes(_best_of_tasks(counts, ["_e", "_late"], key, n), key, n, lanes, lateness)
    return best.select(from_epoch_us("_e").alias("window_end"), "firing", "rank", key, "cnt")


def _slide_counts(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str]) -> DataFrame:
    """``w, *keys, cnt``. Rows are counted in panes as long as the slide, and only these counts
    are copied to the windows they lie in."""
    panes = df.groupBy(F.window(ts, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    return panes.groupBy(F.window("w", size, slide).alias("w"), *keys).agg(F.sum("_n").alias("cnt"))


def slide_counts(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per key and sliding window."""
    counts = _slide_counts(df, ts, size, slide, list(keys))
    return plain_times(
        counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "cnt"))


def _summed(rows: DataFrame, group: Sequence[str], fold: str = "sum") -> DataFrame:
    """``rows`` of ``group`` and ``_v`` with ``_v`` summed up (or folded) within every batch of rows of a task."""
    group = list(group)

    def summed(batches):
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(group).aggregate([("_v", fold)])
            for part in t.rename_columns([*group, "_v"] if t.column_names[0] == group[0] else ["_v", *group]).to_batches():
                yield part.select([*group, "_v"])

    return rows.mapInArrow(summed, rows.schema)


def early_totals(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], value: str, offset: str | None = None,
    forget: str | None = None,
) -> DataFrame:
    """Totals of whole numbers per key and tumbling window as they grow, before the window ends.

    After each micro-batch, so at the interval of the query's trigger, every total it changed is
    put out with its number ``firing``; the row of the largest number is the last word. Rows are
    summed up in their tasks first, so a hot key sends a row for each batch of rows. No row is too
    late, unless its total was left alone for ``forget`` and started anew.
    """
    keys = list(keys)
    rows = df.select(tumbling(F.col(ts), size, offset).alias("_w"), *keys, F.col(value).cast("bigint").alias("_v"))
    rows = rows.select(epoch_us("_w.start").alias("_a"), epoch_us("_w.end").alias("_b"), *keys, "_v")
    group = ["_a", "_b", *keys]

    partial = _summed(rows, group)
    mode = PROCESSING_TIME if forget else BY_ARRIVAL
    out = _process(partial, group, p.EarlyTotal("_v", forget and micros(forget) // 1000), _long("firing", "total"), mode)
    return out.select(
        from_epoch_us("_a").alias("window_start"), from_epoch_us("_b").alias("window_end"), *keys, "firing", "total")


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return plain_times(windows.session_stream(df, ts, gap, keys, *aggs))


def payment_join(pays, receipts, on, pay_ts, receipt_ts, wait) -> DataFrame:
    """Interval join of two streams that both carry watermarks."""
    return joins.interval_join(pays, receipts, on, pay_ts, receipt_ts, f"{-micros(wait)} microseconds", wait)


def smallest_by_marker(
    df: DataFrame, ts: str, key: str, value: str, marker: Column, size: str, bound: str = "0 seconds"
) -> DataFrame:
    """Minimum per key and window when only ``marker`` rows move the watermark. Rows are cut to those that
    can matter in their tasks first; a window of a key is one entry of the state."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withColumn(US, epoch_us(ts))
    mark = F.when(marker | (F.col(ts) >= F.lit(END)), F.col(ts))
    marked = _before_end(with_watermark(timed.withColumn("_mark", mark), "_mark", bound), "_mark")
    width = micros(size)
    rows = marked.where(F.col(US).isNotNull()).select(
        F.col(key).alias("_key"), (floor_div(F.col(US), width) * width).alias("_start"), "_mark", F.col(value).cast("double").alias("_v"))
    out = _process(
        packs.reduced(rows, _smallest), ["_key", "_start"], p.MarkedWindow("_v", width),
        [T.StructField("min_value", T.DoubleType())], EVENT_TIME,
    )
    return out.select(
        F.col("_key").alias(key), from_epoch_us("_start").alias("window_start"),
        from_epoch_us(F.col("_start") + width).alias("window_end"), "min_value"
    )


def _smallest(t: pa.Table) -> pa.Table:
    """The rows that can be the minimum of their key and window. Spark leaves marker rows out that are
    behind the watermark when they come, so a row is spared only for one that is as small and stays as long:
    later marks stay longer, and rows without one always. NaN is above all numbers, and NULL above that."""
    _, order, at = packs.grouped(t, ["_key", "_start"])
    if not len(order):
        return t
    t = t.take(pa.array(order))
    group = np.repeat(np.arange(len(at) - 1), np.diff(at))
    number = t["_v"].fill_null(0.0).to_numpy()
    kind = np.where(t["_v"].is_null().to_numpy(), 2, np.isnan(number))
    mark = t["_mark"].cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
    value = np.where(kind > 0, 0.0, number)
    by_value = np.lexsort((value, kind))
    value, kind = value[by_value], kind[by_value]
    rank = np.empty(len(t), np.int64)
    rank[by_value] = np.cumsum(np.concatenate([[False], (value[1:] != value[:-1]) | (kind[1:] != kind[:-1])]))
    # Longest kept first, then smallest; a row stays if it is below all before it in its group.
    order = np.lexsort((rank, -mark, group))
    group, rank = group[order], rank[order]
    low = np.minimum.accumulate(rank + (group[-1] - group) * (rank.max() + 1))
    stays = np.concatenate([[True], low[1:] < low[:-1]])
    return t.take(pa.array(order[stays]))


# --- running values, by arrival ------------------------------------------------------------


def running_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], combine: Callable
) -> DataFrame:
    """The running reduce after every row; ``combine`` need not be associative here."""
    order, names = list(order), list(fields)
    held = _fields(df, *names)

    def pick(row):
        return tuple(row[n] for n in names)

    def emit(key, row, value):
        return (*key, *[row[c] for c in order], *value)

    out = _fields(df, *order) + [T.StructField(f"reduced_{f.name}", f.dataType) for f in held]
    return _process(df, keys, p.KeyedReduce(order, T.StructType(held), pick, combine, emit), out, BY_ARRIVAL)


FOLDS = {"sum": lambda a, b: a + b, "min": min, "max": max}


def running_fold(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, slices: Column, fold: str = "sum", out: str = "total"
) -> DataFrame:
    """The running sum, minimum or maximum of whole numbers after every row, with hot keys spread.

    ``slices`` numbers stretches of a key's order (it must not fall where the order rises). The
    slices of a micro-batch are folded by tasks of their own: partial folds go ahead to one row per
    key and slice, where the key's state turns them into what each slice starts from. Rows of a
    later micro-batch come later. NULL values change nothing; before the first value the result is
    NULL. A task sorts one slice of one micro-batch in memory.
    """
    keys, order = list(keys), list(order)
    rows = df.select(*keys, *[c for c in order if c not in keys], slices.cast("bigint").alias("_slice"), F.col(value).cast("bigint").alias("_v"))
    function = {"sum": "sum", "min": "min", "max": "max"}[fold]
    partial = _summed(rows.select(*keys, "_slice", "_v"), [*keys, "_slice"], function)
    starts = _process(partial, keys, p.SliceCarry("_v", FOLDS[fold]), _long("_slice", "_v"), BY_ARRIVAL)
    none = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order if c not in keys]
    columns = [*keys, *[c for c in order if c not in keys], "_slice", "_v", "_carried"]
    both = rows.withColumn("_carried", F.lit(False)).select(*columns).union(
        starts.select(*keys, *none, "_slice", "_v", F.lit(True).alias("_carried")).select(*columns))
    fields = [c for c in order if c not in keys]
    done = _process(both, [*keys, "_slice"], p.SliceFold(fields, "_v", FOLDS[fold]), _fields(df, *fields) + _long(out), BY_ARRIVAL)
    return done.drop("_slice")


def count_windows(df, keys, order, value, size, every, out="total") -> DataFrame:
    return _process(df, keys, p.CountWindow(order, value, size, every), _long("firing", out), BY_ARRIVAL)


def changelog(df, keys, order, value, total="total", having=None, slices: Column | None = None) -> DataFrame:
    """The updates of a running sum of whole numbers, for totals that ``having`` holds for: the old one taken
    back, the new one put in. ``slices`` spreads hot keys as in :func:`running_fold`; without, a key's rows
    of a micro-batch are sorted in one task."""
    keys, order = list(keys), [c for c in order if c not in keys]
    slice_ = F.lit(0) if slices is None else slices
    rows = df.select(*keys, *order, slice_.cast("bigint").alias("_slice"), F.col(value).cast("bigint").alias("_v"))
    group = [*keys, "_slice"]
    partial = packs.reduced(rows.select(*group, "_v"), lambda t: packs.sums(t, group, "_v"))
    starts = _process(partial, keys, p.SliceCarry("_v", FOLDS["sum"]), _long("_slice", "_v"), BY_ARRIVAL)
    packed = packs.packed(rows, group, [*order, "_v"])
    both = packed.select(*group, F.lit(None).cast("bigint").alias("_v"), packs.ROWS).union(
        starts.select(*group, "_v", F.lit(None).cast("binary").alias(packs.ROWS)))
    told = _process(both, group, p.Changelog(order, having), [T.StructField(packs.ROWS, T.BinaryType())], BY_ARRIVAL)
    fields = [*_fields(df, *order), T.StructField("inserted", T.BooleanType()), *_long("_total")]
    return packs.unpacked(told, keys, fields).withColumnRenamed("_total", total)


def split_late(
    df: DataFrame, ts: str, spread: str, bound: str, window: str, lateness: str
) -> DataFrame:
    """The rows of a stream with ``window_start``, ``window_end`` and ``lateness``, as
    :func:`.late.split_late` gives them with micro-batches for arrivals: rows that come too late
    are put out like all others and not dropped. ``spread`` is a column that deals rows to tasks;
    the rows of a value and micro-batch pass one task, one by one.
    """
    columns = [c for c in df.columns if c not in (ts, spread)]
    timed = with_watermark(df.withColumn(ts, F.col(ts).cast("timestamp")), ts, bound)
    width = micros(window)
    # Without the event-time column Spark does not look for late rows itself.
    slim = timed.select(spread, epoch_us(ts).alias(US), *columns).withColumn(
        "_b", (floor_div(F.col(US), width) + 1) * width)
    out = [*_long(US), *_fields(df, *columns), *_long("_b"), _text("lateness")]
    tags = p.LateTag([US, *columns, "_b"], "_b", micros(lateness), [ON_TIME, REFIRE, DROPPED])
    told = _process(slim, [spread], tags, out, EVENT_TIME)
    return told.select(
        spread, from_epoch_us(US).alias(ts), *columns, from_epoch_us(F.col("_b") - width).alias("window_start"),
        from_epoch_us("_b").alias("window_end"), "lateness")


# --- state and timers, in event-time order -------------------------------------------------


def jump_alert(df, keys, order, value, threshold) -> DataFrame:
    out = _long(US) + _fields(df, *order) + [T.StructField(n, T.DoubleType()) for n in (value, "previous")]
    df = df.withColumn(value, F.col(value).cast("double"))  # as the state holds it
    return _ordered(df, keys, p.JumpAlert, order, [value], out, value=value, threshold=threshold).drop(US)


def rise_alert(df, keys, order, value, lasting) -> DataFrame:
    out = _ordered(
        df.withColumn(value, F.col(value).cast("double")), keys, p.RiseAlert, order, [value], _long("_a", "_b"), value=value, lasting=micros(lasting)
    )
    return out.select(*keys, from_epoch_us("_a").alias("rise_start"), from_epoch_us("_b").alias("alert_time"))


def daily_cap(df, keys, order, cap) -> DataFrame:
    out = _long(US) + _fields(df, *order) + [_text("tag")]
    capped = _ordered(df, keys, p.DailyCap, order, [], out, cap=cap)
    return capped.select(*keys, from_epoch_us(US).alias("ts"), *order, "tag")


PAGE_BITS = 1 << 20  # bits of one page of a window's bitmap
SLICES = 16  # parts of a window that are counted by tasks of their own


def running_distinct_bitmap(
    df, ts, size, value, order, out="uv", page_bits: int = PAGE_BITS, slices: int = SLICES
) -> DataFrame:
    """For every row, the bitmap estimate of distinct values in its window so far.

    The rows of a window are spread twice: by the page of the bitmap their bit lies in, where
    first-seen bits are marked, and by time into slices, which are counted by themselves and then
    raised by the totals of the slices before.
    ``order`` are whole-number columns that order rows of one time.
    """
    width = micros(size)
    bit = df.withColumns({"_end": (floor_div(F.col(US), width) + 1) * width, "_at": bitmap_offset(value)})
    paged = bit.withColumns({"_page": F.coalesce(floor_div(F.col("_at"), page_bits), F.lit(-1)),
                             "_bit": F.pmod(F.col("_at"), F.lit(page_bits)), "_until": F.col("_end")})
    columns = _long(US) + _fields(df, *order)
    flagged = _ordered(paged, ["_end", "_page"], p.FirstSeen, order, ["_bit", "_until"], columns + _long("_fresh"),
                       bit="_bit", end="_until")
    part = F.least(floor_div(F.col(US) - (F.col("_end") - width), width // slices), F.lit(slices - 1))
    counted = _ordered(
        flagged.withColumn("_slice", part), ["_end", "_slice"], p.SliceCount, order, ["_fresh"],
        [T.StructField("_carry", T.BooleanType()), *columns, *_long("_n")], fresh="_fresh", window=width, slices=slices)
    held = _ordered(counted, ["_end", "_slice"], p.Carry, order, ["_carry", "_n"], columns + _long(out),
                    carry="_carry", n="_n", window=width)
    return held.select(*order, from_epoch_us("_end").alias("window_end"), out)


def login_failures(df, keys, order, failed: Column, within) -> DataFrame:
    flagged = df.withColumn("_failed", failed)
    out = _ordered(
        flagged, keys, p.RepeatedFailure, order, ["_failed"], _long("_a", "_b"),
        failed="_failed", within=micros(within),
    )
    return out.select(
        *keys, from_epoch_us("_a").alias("first_fail_time"), from_epoch_us("_b").alias("last_fail_time")
    )


def login_bursts(df, keys, order, failed: Column, within, least) -> DataFrame:
    flagged = df.withColumn("_failed", failed)
    out = _ordered(
        flagged, keys, p.FailureBurst, order, ["_failed"], _long("_a", "_b", "n"),
        failed="_failed", within=micros(within), least=least,
    )
    return out.select(
        *keys, from_epoch_us("_a").alias("first_fail_time"), from_epoch_us("_b").alias("last_fail_time"), "n"
    )


def order_status(df, keys, order, created: Column, paid: Column, limit, forget=None) -> DataFrame:
    """Statuses with the ``order`` columns (ids, whole numbers) of the create, or of the pay that had none."""
    flagged = df.withColumns({"_created": created, "_paid": paid})
    out = _ordered(
        flagged, keys, p.OrderPayment, order, ["_created", "_paid"],
        _long("_a", "_b") + [_text("tag")] + _fields(df, *order),
        created="_created", paid="_paid", limit=micros(limit), forget=forget and micros(forget),
    )
    return out.select(
        *keys, from_epoch_us("_a").alias("create_time"), from_epoch_us("_b").alias("pay_time"), "tag", *order
    )


def order_check(df, keys, order, created: Column, paid: Column, limit) -> DataFrame:
    flagged = df.withColumns({"_created": created, "_paid": paid})
    out = _ordered(
        flagged, keys, p.OrderCheck, order, ["_created", "_paid"], _long("_a") + [_text("tag")],
        created="_created", paid="_paid", limit=micros(limit),
    )
    return out.select(*keys, from_epoch_us("_a").alias("create_time"), "tag")


def match_sequence(df, keys, row_id: str, steps: Sequence[Step], within) -> DataFrame:
    """Sequences per key: first and last row reached, steps reached, ``match`` or ``timeout``."""
    flags = {f"_is{i}": s.when for i, s in enumerate(steps)}
    out_fields = _long("first_id", "_a", "last_id", "_b") + [T.StructField("matched", T.IntegerType()), _text("tag")]
    out = _ordered(
        df.withColumns(flags), keys, p.SequenceMatcher, [row_id], list(flags), out_fields,
        flags=list(flags), strict=[s.strict for s in steps], within=micros(within),
    )
    return out.select(
        *keys, "first_id", from_epoch_us("_a").alias("first_time"), "last_id",
        from_epoch_us("_b").alias("last_time"), "matched", "tag",
    )
