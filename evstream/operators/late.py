"""Late rows: what a watermark would have made of each row, on a table of arrivals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evstream.functions.time import epoch_us, from_epoch_us, micros, pane_index
from evstream.operators.common import key_join
from evstream.operators.timeline import running_max, timeline

ON_TIME, REFIRE, DROPPED = "on_time", "refire", "dropped"


def with_watermark(df: DataFrame, ts: str, bound: str) -> DataFrame:
    """Declare event time and out-of-orderness; tables pass through unchanged."""
    return df.withWatermark(ts, f"{micros(bound) // 1000} milliseconds") if df.isStreaming else df


def with_arrival(df: DataFrame) -> DataFrame:
    """Mark each row read from files with the file it arrived in and that file's time, which
    order the arrival batches for :func:`split_late`."""
    return df.withColumns(
        {
            "arrival_time": F.col("_metadata.file_modification_time"),
            "arrival_file": F.col("_metadata.file_path"),
        }
    )


def watermark_before(df: DataFrame, ts: str, arrival: str, bound: str) -> DataFrame:
    """Add the watermark in force when a row's arrival batch starts (null in the first one):
    the greatest event time of all earlier batches minus ``bound``."""
    tops = df.groupBy(arrival).agg(F.max(epoch_us(ts)).alias("_top"))
    held = (
        timeline(tops, [], [arrival])
        .forward(include_current=False, _before=running_max("_top"))
        .done()
        .select(arrival, from_epoch_us(F.col("_before") - micros(bound)).alias("watermark"))
    )
    return key_join(df, held, [arrival])


def split_late(
    df: DataFrame, ts: str, arrival: str, bound: str, window: str, lateness: str
) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``lateness``: ``on_time`` while the row's window
    has not fired, ``refire`` while it is kept for late rows, ``dropped`` afterwards."""
    rows = watermark_before(df, ts, arrival, bound)
    width = micros(window)
    start = pane_index(ts, width) * width
    mark = epoch_us("watermark")
    status = (
        F.when(F.col("watermark").isNull() | (start + width > mark), ON_TIME)
        .when(start + width + micros(lateness) > mark, REFIRE)
        .otherwise(DROPPED)
    )
    return rows.withColumns(
        {
            "window_start": from_epoch_us(start),
            "window_end": from_epoch_us(start + width),
            "lateness": status,
        }
    )


def first_firing(late: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Window results as first put out, from the rows that were on time."""
    return (
        late.where(F.col("lateness") == ON_TIME)
        .groupBy(*keys, "window_start", "window_end")
        .agg(*aggs)
    )


def refirings(late: DataFrame, keys: Sequence[str], arrival: str, value: Column, out: str) -> DataFrame:
    """Corrected sums: one row per window and arrival batch that brought kept late rows, holding
    the sum over everything up to that batch."""
    kept = late.where(F.col("lateness") != DROPPED)
    per_batch = kept.groupBy(*keys, "window_start", "window_end", arrival).agg(
        F.sum(value).alias("_part"),
        F.max(F.when(F.col("lateness") == REFIRE, 1).otherwise(0)).alias("_late"),
    )
    # One row per batch that reached the window: few, whatever the number of rows.
    w = Window.partitionBy(*keys, "window_start", "window_end").orderBy(arrival)
    total = F.sum("_part").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        per_batch.withColumn(out, total)
        .where(F.col("_late") == 1)
        .select(*keys, "window_start", "window_end", arrival, out)
    )


def too_late(late: DataFrame) -> DataFrame:
    """The rows no window takes any more, as they came."""
    return late.where(F.col("lateness") == DROPPED).drop(
        "lateness", "watermark", "window_start", "window_end"
    )
