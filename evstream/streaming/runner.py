"""Starting streams, restarting them after failures, and reading what they wrote."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from evstream.session import planned_bytes, prepare_streaming, scratch_path
from evstream.streaming.jobs import END

# Input bytes one state partition stands for; their number has no upper limit.
STATE_BYTES_PER_TASK = 256 * 1024 * 1024


@dataclass(frozen=True)
class Restart:
    """How often a failed query is started again on its checkpoint.

    ``attempts`` restarts in all, or, with ``per_seconds``, at most that many within any span of
    that length; ``delay`` seconds pass before each.
    """

    attempts: int = 0
    delay: float = 0.0
    per_seconds: float | None = None

    @staticmethod
    def never() -> "Restart":
        return Restart()

    @staticmethod
    def fixed(attempts: int, delay: float) -> "Restart":
        return Restart(attempts, delay)

    @staticmethod
    def rate(attempts: int, per_seconds: float, delay: float) -> "Restart":
        return Restart(attempts, delay, per_seconds)


class Closing:
    """The end of a bounded input, as one row whose time lies beyond every window and timer.

    A stream never learns that its input has ended, so the last windows and time-outs would stay
    in its state. :meth:`follow` adds a source that is empty at first; once the input is drained,
    :meth:`write` puts a row at ``END`` there, and the next run of the query passes the watermark
    on to it. :func:`.jobs.event_time` keeps the row itself out of the results.

    With ``at_once`` the row is there from the start, which spares the second run. That is right only
    for an input that one micro-batch takes whole: the watermark moves when the batch is over, and
    the batch without rows that Spark adds then puts everything out.
    """

    def __init__(self, like: DataFrame, ts: str, at_once: bool = False):
        self.spark, self.schema, self.at_once = like.sparkSession, like.schema, at_once
        self.path = scratch_path(self.spark, "closing")
        end = {ts: F.lit(END)}
        self.row = self.spark.range(1).select(
            *[end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema]
        )
        (self.row if at_once else self.row.limit(0)).write.parquet(self.path)

    def follow(self, rows: DataFrame) -> DataFrame:
        """``rows`` and, after :meth:`write`, the closing row. Filters on other columns than the
        event time belong before this: Spark moves them below the watermark."""
        return rows.union(self.spark.readStream.schema(self.schema).parquet(self.path))

    def write(self) -> None:
        self.row.write.mode("append").parquet(self.path)


def run_stream(
    build: Callable[[], DataStreamWriter], restart: Restart = Restart.never(), drain: bool = False
) -> StreamingQuery:
    """Start the query ``build`` describes and wait for its end, starting it anew on failure.

    With ``drain`` the query has no end of its own and is stopped once its sources have no more.

    ``build`` is called for every start and must name the same checkpoint location, which holds
    offsets and state: the totals after a restart are those of an unbroken run.
    """
    failures: deque[float] = deque()
    while True:
        query = build().start()
        try:
            if drain:
                query.processAllAvailable()
                query.stop()
            query.awaitTermination()
            return query
        except StreamingQueryException:
            now = time.monotonic()
            failures.append(now)
            while restart.per_seconds is not None and now - failures[0] > restart.per_seconds:
                failures.popleft()
            if len(failures) > restart.attempts:
                raise
            time.sleep(restart.delay)


def run_to_table(
    stream: DataFrame, name: str, folder: str | None = None, source: DataFrame | None = None,
    restart: Restart = Restart.never(), closing: Closing | None = None, limited: bool = False,
) -> DataFrame:
    """Drain an append-mode stream into a table in the shared folder and read it back.

    ``source`` is a batch view of the input: the number of state partitions, fixed at the first
    start of a query, then follows its size. With ``closing`` the query runs once more after its
    input, so that everything still in its state comes out. ``limited`` is for a source that bounds its
    micro-batches itself (:func:`evstream.sources.groups.row_groups`). :func:`stream_of` reads such
    a ``folder`` as the input of a next query.
    """
    spark = prepare_streaming(stream.sparkSession)
    folder = folder or scratch_path(spark, name)
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if source is not None:
        cores = spark.sparkContext.defaultParallelism
        wanted = max(cores, planned_bytes(source) // STATE_BYTES_PER_TASK)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))

    def build() -> DataStreamWriter:
        writer = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{folder}/table")
            .option("checkpointLocation", f"{folder}/checkpoint")
        )
        return writer if limited else writer.trigger(availableNow=True)

    try:
        run_stream(build, restart, limited)
        if closing is not None and not closing.at_once:
            closing.write()
            run_stream(build, restart, limited)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def stream_of(table: DataFrame, folder: str) -> DataFrame:
    """The rows :func:`run_to_table` wrote to ``folder``, as a stream."""
    return table.sparkSession.readStream.schema(table.schema).parquet(f"{folder}/table")
