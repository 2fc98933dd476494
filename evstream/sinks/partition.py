"""A sink made of three functions run in every task: open, write a row, close."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)

from evstream.sinks.committed import opened, qualified


@dataclass
class Written(WriterCommitMessage):
    rows: int


def _write_partition(open_, write, close, rows) -> Written:
    held, n = open_(), 0
    try:
        for row in rows:
            write(held, row)
            n += 1
    except BaseException:
        close(held, False)
        raise
    close(held, True)
    return Written(n)


def partition_sink(
    spark: SparkSession, name: str, open_: Callable, write: Callable, close: Callable
) -> str:
    """Register a sink for tables and streams under ``name``.

    ``open_()`` gives what the task holds, ``write(held, row)`` takes every row, and
    ``close(held, ok)`` ends the task. Tasks can run again, so ``write`` must be idempotent or
    become visible only in ``close``.
    """

    class Batch(DataSourceWriter):
        def write(self, iterator):
            return _write_partition(open_, write, close, iterator)

    class Stream(DataSourceStreamWriter):
        def write(self, iterator):
            return _write_partition(open_, write, close, iterator)

        def commit(self, messages, batchId):
            pass

        def abort(self, messages, batchId):
            pass

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return Batch()

        def streamWriter(self, schema, overwrite):
            return Stream()

    spark.dataSource.register(Sink)
    return name


def text_sink(spark: SparkSession, name: str, folder: str) -> str:
    """Register a sink that writes the first column of its rows as lines, a file per micro-batch
    and task. A file appears when its task ends well, and a task that runs again replaces its
    own. ``folder`` lies where all executors reach it, on Spark's own file system if it names none.
    For files that appear all together see :mod:`.committed`."""
    url = qualified(spark, folder)

    def open_():
        from pyspark import TaskContext

        task = TaskContext.get()
        batch = task.getLocalProperty("streaming.sql.batchId") or "0"
        files, base = opened(url)
        files.create_dir(base, recursive=True)
        path = f"{base}/batch-{int(batch):09d}-part-{task.partitionId():05d}.txt"
        held = f"{base}/_{task.taskAttemptId()}-{int(batch)}.tmp"
        return files, held, path, files.open_output_stream(held)

    def write(held, row):
        held[3].write(f"{row[0]}\n".encode())

    def close(held, ok):
        files, temporary, path, out = held
        out.close()
        files.move(temporary, path) if ok else files.delete_file(temporary)

    return partition_sink(spark, name, open_, write, close)
