"""Scans over the ordered rows of each key that survive hot keys.

Running totals, previous/next rows and nearest matches all need the rows of a key in event
order. A plain window hands a key to one task, which fails when a single key holds a large
part of the table. A :class:`Timeline` keeps ordinary keys whole, in a branch of plain windows, and
cuts the hot ones into consecutive slices of bounded size. Their rows are written out once; a scan
runs inside the slices, and what the earlier (or later) slices contribute is added from a table with
one row per hot slice. So hot keys cost the others nothing but the join that parts them.

The cut points are found by two aggregations over a sample of the key and order columns and
checkpointed, so that a recomputed task sees the same slices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from evstream.operators.common import key_join
from evstream.session import (
    SLICE_FLOOR,
    SLICE_FLOOR_DEFAULT,
    SLICE_ROWS,
    SLICE_ROWS_DEFAULT,
    checkpointed,
    int_setting,
    planned_bytes,
    scratch_path,
)

SLICE = "_slice"
ALL = "_all"
SAMPLED_PER_SLICE = 2000
SAMPLE_SEED = 17


@dataclass(frozen=True)
class Fold:
    """An associative running value: how to compute it in a slice and across slices."""

    kind: str
    value: Column

    def inside(self, scan, reverse: bool) -> Column:
        if self.kind == "previous":
            return F.lag(F.struct(self.value.alias("v"))).over(scan.order_only)
        if self.kind == "nearest":
            return F.last(self.value, ignorenulls=True).over(scan.frame)
        return getattr(F, self.kind)(self.value).over(scan.frame)

    def of_slice(self, order: Sequence[str], reverse: bool) -> Column:
        if self.kind in ("previous", "nearest"):
            seen = self.value.isNotNull() if self.kind == "nearest" else F.lit(True)
            tagged = F.when(seen, F.struct(*order, F.struct(self.value.alias("v")).alias("last")))
            return (F.min if reverse else F.max)(tagged)["last"]
        return getattr(F, self.kind)(self.value)

    def across(self, partial: Column, before) -> Column:
        if self.kind in ("previous", "nearest"):
            return F.last(partial, ignorenulls=True).over(before)
        how = "sum" if self.kind == "count" else self.kind
        return getattr(F, how)(partial).over(before)

    def merge(self, carried: Column, local: Column) -> Column:
        if self.kind == "previous":
            return F.coalesce(local, carried)
        if self.kind == "nearest":
            return F.coalesce(local, carried["v"])
        if self.kind in ("sum", "count"):
            return F.coalesce(carried + local, carried, local)
        return (F.least if self.kind == "min" else F.greatest)(carried, local)

    def finish(self, col: Column) -> Column:
        return col["v"] if self.kind == "previous" else col


def _as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def running_sum(value) -> Fold:
    return Fold("sum", _as_column(value))


def running_count(value=None) -> Fold:
    return Fold("count", F.lit(1) if value is None else _as_column(value))


def running_min(value) -> Fold:
    return Fold("min", _as_column(value))


def running_max(value) -> Fold:
    return Fold("max", _as_column(value))


def nearest(value) -> Fold:
    """The last non-null value seen so far in scan direction."""
    return Fold("nearest", _as_column(value))


def adjacent(value) -> Fold:
    """The value of the row just before in scan direction, null included."""
    return Fold("previous", _as_column(value))


@dataclass(frozen=True)
class _Scan:
    frame: object
    order_only: object


@dataclass(frozen=True)
class Timeline:
    """Rows with the key and order columns a scan needs; those of hot keys apart, with their slice."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None = None
    hot_slices: int = 0

    @property
    def sliced(self) -> bool:
        return self.hot is not None

    def changed(self, change: Callable[[DataFrame], DataFrame]) -> "Timeline":
        """The same timeline after a row-wise change of its table."""
        return replace(self, rows=change(self.rows), hot=None if self.hot is None else change(self.hot))

    def with_slices(self) -> DataFrame:
        """All rows with the number of their slice, 0 for those of ordinary keys."""
        whole = self.rows.withColumn(SLICE, F.lit(0))
        return whole if self.hot is None else whole.unionByName(self.hot)

    def done(self) -> DataFrame:
        rows = self.rows if self.hot is None else self.rows.unionByName(self.hot.drop(SLICE))
        return rows.drop(ALL)

    def forward(self, include_current: bool = True, **folds: Fold) -> "Timeline":
        """Add running values over the rows up to this one (or strictly before it)."""
        return self._scan(folds, include_current, reverse=False)

    def backward(self, include_current: bool = True, **folds: Fold) -> "Timeline":
        """Add running values over the rows from this one on (or strictly after it)."""
        return self._scan(folds, include_current, reverse=True)

    def _scan(self, folds: dict[str, Fold], include_current: bool, reverse: bool) -> "Timeline":
        # A backward scan is a forward scan in descending order: frames that end at the last
        # row would be evaluated anew for every row.
        turn = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
        def inside(parts: Sequence[str]) -> dict[str, Column]:
            ordered = Window.partitionBy(*parts).orderBy(*[turn(c) for c in self.order])
            scan = _Scan(
                ordered.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1), ordered
            )
            return {name: f.inside(scan, reverse) for name, f in folds.items()}

        rows = self.rows.withColumns({n: folds[n].finish(col) for n, col in inside(self.keys).items()})
        if self.hot is None:
            return replace(self, rows=rows)

        partials = self.hot.groupBy(*self.keys, SLICE).agg(
            *[f.of_slice(self.order, reverse).alias(f"_p_{n}") for n, f in folds.items()]
        )
        before = (
            Window.partitionBy(*self.keys)
            .orderBy(turn(SLICE))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = partials.select(
            *self.keys,
            SLICE,
            *[f.across(F.col(f"_p_{n}"), before).alias(f"_c_{n}") for n, f in folds.items()],
        )
        local = inside([*self.keys, SLICE])
        hot = self.hot.withColumns({f"_l_{n}": col for n, col in local.items()})
        hot = key_join(hot, carried, [*self.keys, SLICE], rows=self.hot_slices)
        merged = {
            n: f.finish(f.merge(F.col(f"_c_{n}"), F.col(f"_l_{n}"))) for n, f in folds.items()
        }
        hot = hot.withColumns(merged).drop(*[f"_{t}_{n}" for n in folds for t in "cl"])
        return replace(self, rows=rows, hot=hot)


def timeline(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], like: DataFrame | None = None
) -> Timeline:
    """Rows of ``df`` per key in ``order``; the order columns must identify a row of a key.

    With no keys the whole table is one timeline. Hot keys are cut at values of all order columns,
    so rows of one time can be parted. ``like`` is a table with the same keys and order columns
    that is cheaper to count, for a ``df`` that is itself the result of a scan.
    """
    keys, order = tuple(keys), tuple(order)
    probe = df if like is None else like
    if not keys:
        df, probe, keys = df.withColumn(ALL, F.lit(0)), probe.withColumn(ALL, F.lit(0)), (ALL,)
    spark = df.sparkSession
    whole = Timeline(df, keys, order)
    if planned_bytes(probe) <= int_setting(spark, SLICE_FLOOR, SLICE_FLOOR_DEFAULT):
        return whole

    limit = int_setting(spark, SLICE_ROWS, SLICE_ROWS_DEFAULT)
    # Hot keys and their cut points come from a sample, so that looking for them does not shuffle
    # every key. It decides where work is cut, never what is computed.
    share = min(1.0, SAMPLED_PER_SLICE / limit)
    seen = probe.select(*dict.fromkeys([*keys, *order]))
    if share < 1.0:
        seen = seen.sample(fraction=share, seed=SAMPLE_SEED)
    least = limit if share == 1.0 else 0.8 * limit * share
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most about rows / limit keys can be hot.
    hot = checkpointed(counts.where(F.col("_n") > least))
    n_hot, most, total = hot.agg(F.count(F.lit(1)), F.max("_n"), F.sum("_n")).first()
    if not n_hot:
        return whole

    # Every key is cut after so many of its sampled rows, so into as many slices as it needs.
    per = max(1, int(limit * share))
    n_slices = n_hot + total // per
    hot_rows = key_join(seen, hot.drop("_n"), keys, "left_semi", rows=n_hot)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cut_rows = hot_rows.withColumn("_place", place).where(F.col("_place") % per == 0)
    cuts = checkpointed(
        cut_rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))
    )
    ordinary = key_join(df, cuts.select(*keys), keys, "left_anti", rows=n_hot)
    cut = key_join(df, cuts, keys, "inner", rows=n_slices)
    hot = _written(_with_slice(cut, F.struct(*order), most // per))
    return Timeline(ordinary, keys, order, hot, hot_slices=n_slices)


def _written(rows: DataFrame) -> DataFrame:
    """``rows`` as a table of its own: every scan reads them twice. Columns of no type, which
    Parquet does not hold, are NULL throughout."""
    spark = rows.sparkSession
    untyped = {f.name: F.lit(None) for f in rows.schema if isinstance(f.dataType, T.NullType)}
    kept = rows.drop(*untyped)
    path = scratch_path(spark, "hot-keys")
    kept.write.parquet(path)
    return spark.read.schema(kept.schema).parquet(path).withColumns(untyped)


def _with_slice(rows: DataFrame, at: Column, cuts: int) -> DataFrame:
    """Number the slices of hot keys: 1 + the cut points (at most ``cuts``) at or before ``at``.

    The count is found by halving, one projection per step, which stays in generated code;
    past the end of the cut points ``get`` is null and adds nothing.
    """
    rows = rows.withColumn(SLICE, F.lit(0))
    for bit in reversed(range(max(cuts, 1).bit_length())):
        step = 1 << bit
        before = F.get(F.col("_cuts"), F.col(SLICE) + (step - 1)) <= at
        rows = rows.withColumn(SLICE, F.col(SLICE) + F.when(before, step).otherwise(0))
    return rows.withColumn(SLICE, F.col(SLICE) + 1).drop("_cuts")
