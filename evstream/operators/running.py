"""Running aggregates per key, change logs, latest rows, and user-defined aggregates."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from evstream.functions.hashing import bitmap_offset
from evstream.functions.time import tumbling
from evstream.operators.common import key_join
from evstream.operators.timeline import (
    SLICE,
    Fold,
    nearest,
    running_count,
    running_max,
    running_sum,
    timeline,
)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], **folds: Fold) -> DataFrame:
    """For every row, the folds over the rows of its key so far, this one included."""
    return timeline(df, keys, order).forward(**folds).done()


def running_max_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, cols: Sequence[str]
) -> DataFrame:
    """For every row, ``cols`` of the row with the greatest ``value`` so far, the first of
    equals, under ``max_<col>`` names."""
    # Equal values must favour the earlier row, so its position counts downwards.
    rows = timeline(df, keys, order).forward(_pos=running_count())
    best = F.struct(F.col(value), (-F.col("_pos")).alias("p"), *[F.col(c).alias(f"max_{c}") for c in cols])
    rows = rows.forward(_best=running_max(best)).done()
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], *[f"_best.max_{c}" for c in cols])


def running_field_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first_of: str, step: tuple[str, int],
    current_plus: tuple[str, float],
) -> DataFrame:
    """The pairwise reduce (x, y) -> (x.a, x.b + step, y.c + plus) after every row.

    Folding it from the left gives closed forms: the first row's ``a``, its ``b`` plus one step
    per later row, and the current row's ``c`` plus the constant; the first row goes out as is.
    """
    b, inc = step
    c, plus = current_plus
    rows = timeline(df, keys, order).forward(_n=running_count())
    opening = F.when(F.col("_n") == 1, F.struct(F.col(first_of).alias("a"), F.col(b).alias("b")))
    rows = rows.changed(lambda r: r.withColumn("_open", opening)).forward(_first=nearest("_open"))
    later = F.col("_n") - 1
    return (
        rows.done()
        .withColumn(f"reduced_{first_of}", F.col("_first.a"))
        .withColumn(f"reduced_{b}", F.col("_first.b") + later * inc)
        .withColumn(f"reduced_{c}", F.when(later > 0, F.col(c) + plus).otherwise(F.col(c)))
        .drop("_n", "_open", "_first")
    )


def running_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str],
    combine: Callable[[tuple, tuple], tuple], associative: bool = False,
) -> DataFrame:
    """The running reduce with a Python function over the ``fields`` of two rows.

    Rows of a key stream through ``combine`` in order; one row is held at a time. Only if the
    caller declares it ``associative`` are hot keys cut into slices, whose partial rows are put
    together at the end; the result never depends on the size. NULL fields reach ``combine`` as
    None and integers as they are. The result columns are ``reduced_<field>``.
    """
    keys, fields, order = list(keys), list(fields), list(order)
    tl = timeline(df, keys, order) if associative else None
    sliced = tl is not None and tl.sliced
    rows = tl.with_slices() if sliced else df.withColumn(SLICE, F.lit(0))
    out_schema = T.StructType(
        rows.schema.fields
        + [T.StructField(f"reduced_{f}", rows.schema[f].dataType) for f in fields]
    )
    reduced = _scan_in_order(rows, [*keys, SLICE], order, fields, combine, out_schema)
    if sliced:
        ends = (
            reduced.where(F.col(SLICE) > 0)
            .groupBy(*keys, SLICE)
            .agg(F.max(F.struct(*order, *[f"reduced_{f}" for f in fields])).alias("_e"))
            .select(*keys, SLICE, *[F.col(f"_e.reduced_{f}").alias(f) for f in fields])
        )
        schema = T.StructType(
            ends.schema.fields
            + [T.StructField(f"reduced_{f}", ends.schema[f].dataType) for f in fields]
        )
        totals = _scan_in_order(ends, keys, [SLICE], fields, combine, schema)
        carry = totals.select(
            *keys, (F.col(SLICE) + 1).alias(SLICE), F.lit(True).alias("_carried"),
            *[F.col(f"reduced_{f}").alias(f"_c_{f}") for f in fields]
        )
        reduced = _apply_carry(tl, reduced, carry, fields, combine, out_schema)
    return reduced.select(*[c for c in out_schema.fieldNames() if c not in (SLICE, "_all")])


def _tuples(batch: pa.RecordBatch, names: Sequence[str]) -> list[tuple]:
    if not names:
        return [()] * batch.num_rows
    return list(zip(*[batch.column(c).to_pylist() for c in names], strict=True))


def _with_reduced(batch: pa.RecordBatch, names, fields, rows) -> pa.RecordBatch:
    """The batch's own columns, untouched, and the reduced ones."""
    new = {f"reduced_{f}": pa.array([r[i] for r in rows], batch.schema.field(f).type)
           for i, f in enumerate(fields)}
    return pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)


def _apply_carry(tl, reduced, carry, fields, combine, schema):
    # Cut points are values of the data, so no slice but the first of a key can be empty and
    # the total to add is always that of the slice just before.
    keys = list(tl.keys)
    joined = key_join(reduced, carry, [*keys, SLICE], rows=tl.hot_slices)
    names = schema.fieldNames()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, here = _tuples(b, [f"_c_{f}" for f in fields]), _tuples(b, [f"reduced_{f}" for f in fields])
            carried = b.column("_carried").to_pylist()
            new = [combine(c, h) if there else h for there, c, h in zip(carried, held, here, strict=True)]
            yield _with_reduced(b, names, fields, new)

    return joined.mapInArrow(add, schema)


def _scan_in_order(df, parts, order, fields, combine, schema):
    """Left fold along each group, over sorted partitions read batch by batch."""
    names = schema.fieldNames()
    spread = df.repartition(*parts).sortWithinPartitions(*parts, *order) if parts else (
        df.coalesce(1).sortWithinPartitions(*order))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        for b in batches:
            out = []
            for key, row in zip(_tuples(b, parts), _tuples(b, fields), strict=True):
                held = row if key != group else combine(held, row)
                group = key
                out.append(held)
            yield _with_reduced(b, names, fields, out)

    return spread.mapInArrow(scan, schema)


def changelog(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, total: str = "total",
    having: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The updates a running group-by sum makes to its result table.

    Per input row: ``false`` with the old total (if there was one), then ``true`` with the new
    one. With ``having`` a total is inserted when it enters the filter and retracted when it
    leaves. A total that stays the same is no update, nor is a NULL value.
    """
    used = df.select(*keys, *order, F.col(value)).withColumn("_is", F.col(value).isNotNull().cast("int"))
    rows = timeline(used, keys, order).forward(_new=running_sum(value), _n=running_sum("_is")).done()
    # The sum before the row: NULL values leave it as it is, and there is none before the first other.
    rows = rows.withColumn("_old", F.when(F.col("_is") == 0, F.col("_new")).when(
        F.col("_n") > 1, F.col("_new") - F.col(value)))
    changed = ~F.col("_old").eqNullSafe(F.col("_new"))
    shown = having or (lambda c: F.lit(True))
    gone = F.when(
        changed & F.col("_old").isNotNull() & shown(F.col("_old")),
        F.struct(F.lit(False).alias("inserted"), F.col("_old").alias(total)),
    )
    come = F.when(
        changed & shown(F.col("_new")), F.struct(F.lit(True).alias("inserted"), F.col("_new").alias(total))
    )
    updates = rows.select(*keys, *order, F.explode(F.array(gone, come)).alias("_u"))
    return updates.where(F.col("_u").isNotNull()).select(*keys, *order, "_u.inserted", f"_u.{total}")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, found by partial aggregation."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(last).select(*keys, "_r.*")


def bitmap_distinct_running(
    df: DataFrame, ts: str, size: str, value: str, order: Sequence[str], out: str = "uv"
) -> DataFrame:
    """For every row, the bitmap estimate of distinct values in its window so far. Rows without an
    event time are in no window and left out."""
    rows = df.where(F.col(ts).isNotNull()).select(*df.columns, tumbling(F.col(ts), size).alias("_w")).select(
        *df.columns,
        F.col("_w.end").alias("window_end"),
        bitmap_offset(value).alias("_bit"),
    )
    first = timeline(rows, ["window_end", "_bit"], order).forward(_seen=running_count()).done()
    fresh = first.withColumn("_fresh", F.when(F.col("_seen") == 1, 1).otherwise(0)).drop("_seen", "_bit")
    per_window = timeline(fresh, ["window_end"], order, like=rows)
    return per_window.forward(**{out: running_sum("_fresh")}).done().drop("_fresh")


class UserAggregate:
    """A user-defined aggregate. ``add`` takes a pandas frame of one key, so it is vectorised;
    accumulators are any picklable value."""

    def create(self):
        raise NotImplementedError

    def add(self, acc, rows: pd.DataFrame):
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc) -> tuple:
        raise NotImplementedError


def user_aggregate(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], fn: UserAggregate, result: T.StructType,
    fan_in: int = 256, keep: int = 50_000,
) -> DataFrame:
    """Group by ``keys`` and aggregate with ``fn``.

    Every task reduces its own rows before the shuffle and holds at most ``keep`` accumulators.
    The partials of a key are merged in two steps, first in ``fan_in`` groups, so that the
    partials of a hot key do not meet in one task unmerged.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    part_schema = T.StructType(
        key_fields + [T.StructField("_lane", T.IntegerType()), T.StructField("_acc", T.BinaryType())]
    )

    def flush(held, lane):
        cols = {k: [key[i] for key in held] for i, k in enumerate(keys)}
        return pd.DataFrame({**cols, "_lane": lane, "_acc": [pickle.dumps(a) for a in held.values()]})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        lane = 0
        for pdf in batches:
            lane = int(pdf["_lane"].iloc[0]) if len(pdf) else lane
            for key, rows in pdf.groupby(keys, dropna=False, sort=False):
                key = key if isinstance(key, tuple) else (key,)
                key = tuple(None if pd.isna(k) else k for k in key)
                held[key] = fn.add(held[key] if key in held else fn.create(), rows)
            if len(held) > keep:
                yield flush(held, lane)
                held = {}
        if held:
            yield flush(held, lane)

    def merged(pdf: pd.DataFrame):
        accs = (pickle.loads(a) for a in pdf["_acc"])
        acc = next(accs)
        for other in accs:
            acc = fn.merge(acc, other)
        return acc

    def merge_lane(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[:1].copy()
        out["_acc"] = [pickle.dumps(merged(pdf))]
        return out

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        row = dict(zip(result.fieldNames(), fn.result(merged(pdf))))
        out = pdf.iloc[:1][keys].copy()
        for name, v in row.items():
            out[name] = [v]
        return out

    lanes = df.select(*keys, *values, F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_lane"))
    partials = lanes.mapInPandas(partial, part_schema)
    laned = partials.groupBy(*keys, "_lane").applyInPandas(merge_lane, part_schema)
    return laned.groupBy(*keys).applyInPandas(finish, T.StructType(key_fields + result.fields))


def map_partitions(
    df: DataFrame, schema: T.StructType | str, open_, each: Callable, close: Callable | None = None
) -> DataFrame:
    """Map Arrow-batched pandas frames with a resource opened and closed once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = open_()
        try:
            for pdf in batches:
                yield each(held, pdf)
        finally:
            if close is not None:
                close(held)

    return df.mapInPandas(run, schema)
