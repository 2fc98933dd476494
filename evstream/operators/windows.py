"""Tumbling, sliding, session and count windows over event time, and top-N per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evstream.functions.time import (
    epoch_us,
    floor_div,
    from_epoch_us,
    micros,
    pane_index,
    pane_start,
    readable,
    tumbling,
)
from evstream.operators.timeline import adjacent, running_count, running_sum, timeline


def tumble(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], *aggs: Column, offset: str | None = None
) -> DataFrame:
    """Aggregates per key and ``[start, end)`` window; runs on tables and on streams."""
    out = df.groupBy(tumbling(F.col(ts), size, offset).alias("_w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("_w", *keys)]
    return out.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *names
    )


def slide_stream(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], *aggs: Column
) -> DataFrame:
    """Sliding window in the form a stream accepts; on tables use :func:`slide`."""
    out = df.groupBy(F.window(ts, size, slide).alias("_w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("_w", *keys)]
    return out.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *names
    )


def slide(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    extremes: dict[str, tuple[str, Column]] | None = None,
    count: str | None = "cnt",
) -> DataFrame:
    """Sliding windows of a table without copying every row ``size / slide`` times.

    Rows are first reduced to one row per key and slide-long pane, so no key is ever shuffled
    whole. ``sums`` must be exact under subtraction (integers or decimals). ``extremes`` maps a
    name to ``("min" | "max", column)``.

    Counts and sums enter at a pane and leave ``size / slide`` panes later: the window value is
    a running total over these two kinds of change, and work is panes plus windows put out.
    Extremes cannot be taken back, so with them each pane is copied to its windows.
    """
    sums, extremes = dict(sums or {}), dict(extremes or {})
    width, step = micros(size), micros(slide)
    if width % step:
        raise ValueError("size must be a multiple of slide")
    n = width // step
    panes = df.groupBy(*keys, pane_index(ts, step).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[getattr(F, how)(c).alias(name) for name, (how, c) in extremes.items()],
    )
    if extremes:
        ends = panes.withColumn("_end", F.explode(F.sequence(F.col("_pane") + 1, F.col("_pane") + n)))
        out = ends.groupBy(*keys, "_end").agg(
            F.sum("_cnt").alias("_cnt"),
            *[F.sum(name).alias(name) for name in sums],
            *[getattr(F, how)(name).alias(name) for name, (how, _) in extremes.items()],
        )
    else:
        # A sum of NULLs alone is NULL: count the panes that have one.
        some = {f"_some_{s}": F.col(s).isNotNull().cast("int") for s in sums}
        out = _sliding_totals(panes.withColumns(some) if some else panes, list(keys), ["_cnt", *sums, *some], n)
        for s in sums:
            out = out.withColumn(s, F.when(F.col(f"_some_{s}") > 0, F.col(s)))
        out = out.drop(*some)
    cols = [pane_start(F.col("_end") - n, step).alias("window_start"),
            pane_start("_end", step).alias("window_end"), *keys]
    if count:
        cols.append(F.col("_cnt").alias(count))
    return out.select(*cols, *sums, *extremes)


def _sliding_totals(panes: DataFrame, keys: list[str], totals: list[str], n: int) -> DataFrame:
    # Two changes per pane: its rows are in the windows ending at pane+1 .. pane+n.
    enter = F.struct((F.col("_pane") + 1).alias("_at"), *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in totals])
    leave = F.struct((F.col("_pane") + 1 + n).alias("_at"), *[(-F.coalesce(F.col(t), F.lit(0))).alias(t) for t in totals])
    changes = panes.select(*keys, F.explode(F.array(enter, leave)).alias("_d")).select(*keys, "_d.*")
    if keys:
        # A key has at most time span / slide panes, however many rows it has.
        by_time = Window.partitionBy(*keys).orderBy("_at")
        total = by_time.rowsBetween(Window.unboundedPreceding, 0)
        held = changes.select(
            *keys,
            "_at",
            F.lead("_at").over(by_time).alias("_next"),
            *[F.sum(t).over(total).alias(t) for t in totals],
        )
    else:
        changes = changes.groupBy("_at").agg(*[F.sum(t).alias(t) for t in totals])
        line = timeline(changes, [], ["_at"]).forward(**{t: running_sum(t) for t in totals})
        held = line.backward(_next=adjacent("_at")).done()
    # A total holds from its change up to the next one; equal times leave the last row only.
    held = held.where((F.col("_cnt") > 0) & (F.col("_next") > F.col("_at")))
    return held.withColumn("_end", F.explode(F.sequence(F.col("_at"), F.col("_next") - 1))).drop("_at", "_next")


def sessions(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], sums: dict[str, Column] | None = None,
    count: str = "cnt",
) -> DataFrame:
    """Session windows of a table: a row more than ``gap`` after the last one opens a new one.

    Rows of one gap-long pane always share a session, so they are first reduced to one row per
    key and pane; the ordered pass sees at most time span / gap rows of a key.
    """
    sums = dict(sums or {})
    width = micros(gap)
    panes = df.groupBy(*keys, pane_index(ts, width).alias("_pane")).agg(
        F.min(epoch_us(ts)).alias("_first"),
        F.max(epoch_us(ts)).alias("_last"),
        F.count(F.lit(1)).alias("_cnt"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    new = F.when(F.col("_prev").isNull() | (F.col("_first") > F.col("_prev") + width), 1).otherwise(0)
    line = timeline(panes, keys, ["_pane"]).forward(_prev=adjacent("_last"))
    line = line.changed(lambda rows: rows.withColumn("_new", new)).forward(_session=running_sum("_new"))
    numbered = line.done()
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            from_epoch_us(F.min("_first")).alias("session_start"),
            from_epoch_us(F.max("_last") + width).alias("session_end"),
            F.sum("_cnt").alias(count),
            *[F.sum(name).alias(name) for name in sums],
        )
        .drop("_session")
    )


def session_stream(df: DataFrame, ts: str, gap: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Session windows in the form a stream accepts."""
    out = df.groupBy(F.session_window(ts, gap).alias("_w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("_w", *keys)]
    return out.select(
        F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *keys, *names
    )


def count_tumble(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, **sums: Column
) -> DataFrame:
    """Every ``size``-th row of a key puts out the sums of the last ``size`` rows."""
    rows = _counted(df, keys, order, sums)
    groups = rows.groupBy(*keys, floor_div(F.col("_rn") - 1, size).alias("firing")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(name).alias(name) for name in sums]
    )
    return groups.where(F.col("_n") == size).select(
        *keys, (F.col("firing") + 1).alias("firing"), *sums
    )


def _counted(df: DataFrame, keys, order, sums: dict[str, Column]) -> DataFrame:
    """The values to be summed, each row with its number within the key."""
    values = df.select(*keys, *order, *[c.alias(name) for name, c in sums.items()])
    return timeline(values, keys, order).forward(_rn=running_count()).done()


def count_slide(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, every: int, **sums: Column
) -> DataFrame:
    """Every ``every``-th row of a key puts out the sums of its last ``size`` rows or fewer."""
    rows = _counted(df, keys, order, sums)
    # Row number r is in the firings whose row number lies in [r, r + size - 1].
    first = floor_div(F.col("_rn") + (every - 1), every)
    last = floor_div(F.col("_rn") + (size - 1), every)
    rows = rows.withColumn("_last", last).withColumn("_first", first).where(F.col("_first") <= F.col("_last"))
    fired = rows.withColumn("firing", F.explode(F.sequence("_first", "_last")))
    groups = fired.groupBy(*keys, "firing").agg(
        F.max("_rn").alias("_top"), *[F.sum(name).alias(name) for name in sums]
    )
    return groups.where(F.col("_top") == F.col("firing") * every).select(*keys, "firing", *sums)


def top_n(
    df: DataFrame, within: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1. Spark keeps only ``n`` rows of a
    group per task before the shuffle, so a large group is never gathered."""
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def window_members(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], tie: str, page: int = 1000
) -> DataFrame:
    """The event times in each window, as text, in pages of at most ``page`` times."""
    rows = df.select(*keys, F.window(ts, size).alias("_w"), F.col(ts).alias("_ts"), F.col(tie).alias("_tie"))
    rows = rows.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "_ts", "_tie"
    )
    numbered = timeline(rows, [*keys, "window_start", "window_end"], ["_ts", "_tie"]).forward(
        _rn=running_count()
    ).done()
    member = F.struct("_rn", readable("_ts", "HH:mm:ss").alias("text"))
    return (
        numbered.groupBy(*keys, "window_start", "window_end", floor_div(F.col("_rn") - 1, page).alias("page"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.sort_array(F.collect_list(member)).alias("_m"))
        .select(*keys, "window_start", "window_end", "page", "cnt",
                F.array_join(F.col("_m.text"), ",").alias("members"))
    )


def distinct_per_window(df: DataFrame, ts: str, size: str, value: str, out: str = "uv") -> DataFrame:
    """Exact distinct count per window. Values are made distinct per window first, spread over
    all tasks, and only then counted."""
    seen = df.select(F.window(ts, size).alias("_w"), F.col(value).alias("_v"))
    return (
        seen.groupBy("_w")
        .agg(F.count_distinct("_v").alias(out))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), out)
    )


def approx_distinct_per_window(
    df: DataFrame, ts: str, size: str, value: str, out: str = "uv", rsd: float = 0.02
) -> DataFrame:
    """Sketch-based distinct count per window; constant memory, tables and streams alike."""
    return tumble(df, ts, size, [], F.approx_count_distinct(value, rsd).alias(out))
