"""Table functions over the rows of a key, for what no built-in function states."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


class RowsOfKey:
    """A function from the ordered rows of one key to rows: made anew for each key, so ``__init__`` is
    its set-up. ``rows`` takes a batch of the key's rows and ``finish`` has the last word; both may
    give record batches of ``schema``. Batches come in order, so nothing but what is wanted is held.
    """

    schema: T.StructType

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def finish(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def apply_by_key(
    df: DataFrame, make: Callable[[], RowsOfKey], schema: T.StructType, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Run a table function over the rows of every key, in order. Rows reach it as Arrow batches; a key
    is one task's, its rows are sorted by Spark and stream by."""

    class Handler:
        def __init__(self):
            self.held = make()

        def eval(self, batch):
            yield from self.held.rows(batch)

        def terminate(self):
            yield from self.held.finish()

    function = F.arrow_udtf(Handler, returnType=schema)
    return function(df.asTable().partitionBy(*keys).orderBy(*order))


class GreedyBatches(RowsOfKey):
    """Consecutive rows joined into batches as long as their ``size`` fits under ``cap``.

    A row larger than the cap is a batch of its own; a NULL size counts as 0. Where
    one batch ends depends on all before it, so no window frame tells it.
    """

    def __init__(self, key: str, first: str, size: str, cap: int, schema: T.StructType):
        self.columns, self.cap, self.schema = (key, first, size), cap, schema
        self.key, self.number, self.open = None, 0, None

    def _batch(self, out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else None for f in self.schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=self.schema.fieldNames())

    def rows(self, batch):
        out = []
        for key, first, size in zip(*[batch.column(c).to_pylist() for c in self.columns], strict=True):
            size = size or 0
            if self.open and self.open[4] + size > self.cap:
                out.append(tuple(self.open))
                self.open = None
            if self.open is None:
                self.number += 1
                self.open = [key, self.number, first, 0, 0]
            self.open[3] += 1
            self.open[4] += size
        yield from self._batch(out)

    def finish(self):
        yield from self._batch([tuple(self.open)] if self.open else [])


def greedy_batches(df: DataFrame, key: str, order: Sequence[str], size: str, cap: int) -> DataFrame:
    """``key, batch, first_<id>, n, total``: the rows of each key in order, cut into batches of at most
    ``cap``. The order's last column names a row."""
    first = order[-1]
    schema = T.StructType([
        df.schema[key], T.StructField("batch", T.LongType()), T.StructField(f"first_{first}", df.schema[first].dataType),
        T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])
    rows = df.select(*dict.fromkeys([key, *order]), F.col(size).cast("bigint").alias("_size"))
    return apply_by_key(rows, lambda: GreedyBatches(key, first, "_size", cap, schema), schema, [key], order)
