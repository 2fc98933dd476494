"""Packs: the rows of a key as Arrow data in one binary column, for processors that work by column.

Spark hands a processor its rows field by field, and each call of it, each access to state and each
result costs far more than the work on a row. Where a stage sees a row for nearly every row of the
input, the rows are reduced or packed in their tasks first, and a processor takes and gives packs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

ROWS = "_rows"
# What a task gathers before it reduces or packs, and the rows of an Arrow batch it hands on.
GATHERED_ROWS, GATHERED_BYTES, BATCH_ROWS = 1 << 18, 32 << 20, 10_000


def pack(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as out:
        out.write_table(t)
    return sink.getvalue().to_pybytes()


def unpack(data) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def grouped(t: pa.Table, group: Sequence[str]) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The groups (a row each), the numbers of their rows one group after the other, and where each
    group starts there, with the end. NULL is a value like others."""
    numbered = t.select(group).append_column("_i", pa.array(np.arange(t.num_rows)))
    found = numbered.group_by(list(group), use_threads=False).aggregate([("_i", "list")])
    lists = found["_i_list"].combine_chunks()
    return found.select(group), lists.flatten().to_numpy(), lists.offsets.to_numpy()


def sums(t: pa.Table, group: Sequence[str], *values: str) -> pa.Table:
    """Sums of whole numbers per group; one beyond 64 bits is an error. The sum of NULLs is NULL."""
    for v in values:
        t = t.set_column(t.column_names.index(v), v, t[v].cast(pa.decimal128(38, 0)))
    found = t.group_by(list(group), use_threads=False).aggregate([(v, "sum") for v in values])
    return pa.table({**{g: found[g] for g in group}, **{v: found[f"{v}_sum"].cast(pa.int64()) for v in values}})


def _full(n: int, size: int) -> bool:
    return n >= GATHERED_ROWS or size >= GATHERED_BYTES


def reduced(rows: DataFrame, reduce: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``rows`` as ``reduce`` leaves them, over what a task gathers. What is left may go through it
    again with further rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        schema = None

        def left() -> list[pa.RecordBatch]:
            t = reduce(pa.Table.from_batches(held))
            return t.select(schema.names).cast(schema).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)

        n = size = 0
        for b in batches:
            schema = schema or b.schema
            held.append(b)
            n, size = n + b.num_rows, size + b.nbytes
            if _full(n, size):
                held = left()
                n, size = sum(x.num_rows for x in held), sum(x.nbytes for x in held)
                if _full(2 * n, 2 * size):
                    yield from held
                    held, n, size = [], 0, 0
        if n:
            yield from left()

    return rows.mapInArrow(run, rows.schema)


def packed(
    rows: DataFrame, group: Sequence[str], payload: Sequence[str], reduce: Callable[[pa.Table], pa.Table] | None = None
) -> DataFrame:
    """``group`` columns and the ``payload`` columns of its rows as packs: one for each group in what a
    task gathers, after ``reduce``."""
    group, payload = list(group), list(payload)
    schema = T.StructType([*[rows.schema[g] for g in group], T.StructField(ROWS, T.BinaryType())])

    def packs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        t = t if reduce is None else reduce(t)
        groups, order, at = grouped(t, group)
        body = t.select(payload).take(pa.array(order)).combine_chunks()
        data = pa.array([pack(body.slice(a, b - a)) for a, b in zip(at, at[1:])], pa.binary())
        yield from groups.append_column(ROWS, data).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = size = 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n, size = n + b.num_rows, size + b.nbytes
            if _full(n, size):
                yield from packs(held)
                held, n, size = [], 0, 0
        if held:
            yield from packs(held)

    return rows.mapInArrow(run, schema)


def unpacked(df: DataFrame, kept: Sequence[str], payload: Sequence[T.StructField]) -> DataFrame:
    """The rows of the packs, each with the ``kept`` columns of its pack."""
    kept = list(kept)
    schema = T.StructType([*[df.schema[k] for k in kept], *payload])
    names = [f.name for f in payload]

    def opened(tables: list[pa.Table], of: pa.Table) -> Iterator[pa.RecordBatch]:
        numbers = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
        t, beside = pa.concat_tables(tables).select(names), of.select(kept).take(pa.array(numbers))
        columns = {**{k: beside[k] for k in kept}, **{n: t[n] for n in names}}
        yield from pa.table(columns).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables, n, size, first = [], 0, 0, 0
            for i, data in enumerate(b.column(ROWS), 1):
                tables.append(unpack(data.as_buffer()))
                n, size = n + tables[-1].num_rows, size + tables[-1].nbytes
                if _full(n, size) or i == b.num_rows:
                    yield from opened(tables, pa.Table.from_batches([b.slice(first, i - first)]))
                    tables, n, size, first = [], 0, 0, i

    return df.select(*kept, ROWS).mapInArrow(run, schema)
