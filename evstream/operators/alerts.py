"""Alerts and caps that depend on the earlier rows of a key.

Rows without an event time (the first order column) have no place in the order and take no part, here
as in the streaming forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evstream.functions.time import epoch_us, from_epoch_us, micros
from evstream.operators.timeline import adjacent, nearest, running_count, running_sum, timeline

PAID, LATE, UNPAID, NO_CREATE = "paid", "late", "timeout", "no create"


def _timed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.where(F.col(order[0]).isNotNull())


def jump_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, threshold: float
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than ``threshold``."""
    rows = timeline(_timed(df, order), keys, order).forward(include_current=False, previous=adjacent(value)).done()
    return rows.where(F.abs(F.col(value) - F.col("previous")) > threshold)


def rise_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, lasting: str
) -> DataFrame:
    """One alert per run without a fall whose first rise is not followed by a fall for
    ``lasting``. Equal values neither start nor end a run."""
    rows = timeline(_timed(df, order), keys, order).forward(include_current=False, _prev=adjacent(value))
    us = epoch_us(order[0])
    turns = {
        "_fall": F.when(F.col(value) < F.col("_prev"), us),
        "_rise": F.when(F.col(value) > F.col("_prev"), us),
    }
    rows = rows.changed(lambda r: r.withColumns(turns))
    rows = rows.forward(_run=running_count("_fall")).backward(
        include_current=False, _next_fall=nearest("_fall")
    )
    runs = rows.done().groupBy(*keys, "_run").agg(
        F.min("_rise").alias("_start"), F.min("_next_fall").alias("_end")
    )
    # Within a run the next fall is the same for all rows, null in the last run of a key.
    lasts = F.col("_end").isNull() | (F.col("_end") - F.col("_start") >= micros(lasting))
    return runs.where(F.col("_start").isNotNull() & lasts).select(
        *keys,
        from_epoch_us("_start").alias("rise_start"),
        from_epoch_us(F.col("_start") + micros(lasting)).alias("alert_time"),
    )


def daily_cap(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cap: int
) -> DataFrame:
    """The first ``cap`` rows of a key per UTC day tagged ``pass`` and the next one tagged
    ``warn``; later rows of the day are left out. Spark discards them before the shuffle."""
    day = F.to_date(F.col(order[0]))
    w = Window.partitionBy(*keys, "_day").orderBy(*order)
    ranked = _timed(df, order).withColumn("_day", day).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap + 1)
    return ranked.withColumn("tag", F.when(F.col("_rn") <= cap, "pass").otherwise("warn")).drop("_day", "_rn")


def repeated_failure(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, within: str
) -> DataFrame:
    """Failures less than ``within`` after the key's previous row, that row a failure as well."""
    rows = _timed(df, order).withColumn("_failed", failed)
    rows = timeline(rows, keys, order).forward(
        include_current=False, _prev=adjacent(F.when(F.col("_failed"), F.col(order[0])))
    ).done()
    soon = epoch_us(order[0]) - epoch_us("_prev") < micros(within)
    return rows.where(F.col("_failed") & soon).select(
        *keys, F.col("_prev").alias("first_fail_time"), F.col(order[0]).alias("last_fail_time")
    )


def order_status(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], created: Column, paid: Column, limit: str
) -> DataFrame:
    """One status per create, from the first pay after it: ``paid`` before ``limit`` has passed,
    ``late`` from then on, ``timeout`` without one. A pay before any create is ``no create``."""
    ts = order[0]
    used = _timed(df, order).where(created | paid).withColumns({"_created": created, "_paid": paid})
    rows = timeline(used, keys, order)
    rows = rows.forward(_creates=running_sum(F.col("_created").cast("int"))).backward(
        include_current=False, _pay=nearest(F.when(F.col("_paid"), F.col(ts)))
    )
    took = epoch_us("_pay") - epoch_us(ts)
    status = (
        F.when(F.col("_pay").isNull(), UNPAID).when(took < micros(limit), PAID).otherwise(LATE)
    )
    orphan = F.col("_paid") & (F.coalesce("_creates", F.lit(0)) == 0)
    return rows.done().where(F.col("_created") | orphan).select(
        *keys,
        F.when(F.col("_created"), F.col(ts)).alias("create_time"),
        F.when(F.col("_created"), F.col("_pay")).otherwise(F.col(ts)).alias("pay_time"),
        F.when(F.col("_created"), status).otherwise(NO_CREATE).alias("tag"),
    )


def order_check(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], created: Column, paid: Column, limit: str
) -> DataFrame:
    """The fixed check: for every create with no pay before it, whether a pay has come by the
    time ``limit`` has passed, that moment included."""
    ts = order[0]
    used = _timed(df, order).where(created | paid).withColumns({"_created": created, "_paid": paid})
    rows = timeline(used, keys, order)
    rows = rows.forward(_pays=running_sum(F.col("_paid").cast("int"))).backward(
        include_current=False, _pay=nearest(F.when(F.col("_paid"), F.col(ts)))
    )
    in_time = epoch_us("_pay") - epoch_us(ts) <= micros(limit)
    return rows.done().where(F.col("_created") & (F.coalesce("_pays", F.lit(0)) == 0)).select(
        *keys,
        F.col(ts).alias("create_time"),
        F.when(F.coalesce(in_time, F.lit(False)), PAID).otherwise(UNPAID).alias("tag"),
    )
