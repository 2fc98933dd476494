"""A stream source over the row groups of Parquet files, with offsets of its own.

The source's state is a place in the sequence of row groups, files in order of their paths: the
last file read and how many of its row groups. A delivery is a folder that a finished write left,
and its name sorts behind those before it. Spark keeps it in the checkpoint of the query, so a
query that failed goes on with the first row group it had not finished.

With a limit a micro-batch takes at most that many row groups, or that many bytes of files where
row groups may be of any size, and one row group at least. :func:`deliver_in_order` lays a table out
so that they ascend in event time: the watermark follows, and state holds what is open at the time
reached, not the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from evstream.session import planned_bytes
from evstream.sinks.committed import opened, qualified

NAME = "evstream_row_groups"


class Groups(InputPartition):
    """Row groups ``first`` to before ``last`` of a file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class GroupReader(DataSourceStreamReader):
    def __init__(
        self, url: str, schema: T.StructType, per_task: int, limit: int | None = None, most_bytes: int | None = None
    ):
        self.url, self.schema, self.per_task = url, schema, per_task
        self.limit, self.most_bytes = limit, most_bytes
        self.place = self.initialOffset()

    def _files(self) -> dict[str, int]:
        """Files of finished deliveries, in order, with their sizes. A write in progress has not left its
        mark yet."""
        from pyarrow import fs

        files, base = opened(self.url)
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True))
        sizes = {f.path[len(base) :].strip("/"): f.size for f in found if f.is_file}
        done = {n.rpartition("/")[0] for n in sizes if n.rpartition("/")[2] == "_SUCCESS"}
        return {
            n: sizes[n] for n in sorted(sizes)
            if n.rpartition("/")[0] in done and n.endswith(".parquet") and n.rpartition("/")[2][0] not in "._"
        }

    def _groups(self, name: str) -> int:
        from pyarrow import parquet

        files, base = opened(self.url)
        with files.open_input_file(f"{base}/{name}") as f:
            return parquet.ParquetFile(f).num_row_groups

    def initialOffset(self) -> dict:
        return {"file": "", "groups": 0}

    def latestOffset(self) -> dict:
        """The end of all that is there or, with a limit, of what it admits after the place reached."""
        files = self._files()
        if self.limit is None and self.most_bytes is None:
            last = next(reversed(files), None)
            return {"file": last, "groups": self._groups(last)} if last else self.initialOffset()
        end, groups, held = self.place, 0, 0
        for name, size in files.items():
            if name < end["file"]:
                continue
            first, last = end["groups"] if name == end["file"] else 0, self._groups(name)
            for g in range(first, last):
                # A file's row groups are taken for equally large.
                groups, held = groups + 1, held + -(-size // last)
                over = self.most_bytes is not None and held > self.most_bytes and groups > 1
                if over or (self.limit is not None and groups > self.limit):
                    return end
                end = {"file": name, "groups": g + 1}
        return end

    def partitions(self, start: dict, end: dict) -> list[Groups]:
        # Spark plans every micro-batch by this and, at a restart, the empty one after the last.
        self.place = end
        if start == end:
            return []
        out = []
        for name in self._files():
            if start["file"] <= name <= end["file"]:
                first = start["groups"] if name == start["file"] else 0
                last = end["groups"] if name == end["file"] else self._groups(name)
                out += [Groups(name, g, min(g + self.per_task, last)) for g in range(first, last, self.per_task)]
        return out

    def read(self, partition: Groups) -> Iterator:
        from pyarrow import parquet
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(self.schema)
        files, base = opened(self.url)
        with files.open_input_file(f"{base}/{partition.path}") as f:
            groups = list(range(partition.first, partition.last))
            # Spark writes its timestamps as 96-bit ones by default.
            source = parquet.ParquetFile(f, coerce_int96_timestamp_unit="us")
            for batch in source.iter_batches(row_groups=groups, columns=kinds.names):
                yield batch.select(kinds.names).cast(kinds)

    def commit(self, end: dict) -> None:
        pass


class GroupSource(DataSource):
    """Rows of the Parquet files of ``path``; the reader's schema says which columns."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema) -> DataSourceStreamReader:
        limits = (self.options.get(name) for name in ("groupsPerBatch", "bytesPerBatch"))
        per_task = int(self.options.get("groupsPerTask", 1))
        return GroupReader(self.options["path"], schema, per_task, *(None if x is None else int(x) for x in limits))


def row_groups(
    spark: SparkSession, path: str, schema: T.StructType, groups_per_task: int = 1,
    groups_per_batch: int | None = None, bytes_per_batch: int | None = None,
) -> DataFrame:
    """The rows of the deliveries below a folder as a stream, ``groups_per_task`` row groups to a task.

    A micro-batch takes all row groups that are there when it starts, or ``groups_per_batch`` of
    them, or as many as fit in ``bytes_per_batch`` (one at least). A query with such a limit is drained by ``run_to_table(..., limited=True)``: the trigger
    ``availableNow`` asks a source of this kind once, and so would end after one micro-batch.
    """
    spark.dataSource.register(GroupSource)
    reader = spark.readStream.format(NAME).schema(schema)
    if groups_per_batch is not None:
        reader = reader.option("groupsPerBatch", groups_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("bytesPerBatch", bytes_per_batch)
    return reader.option("path", qualified(spark, path)).option("groupsPerTask", groups_per_task).load()


# Files of a delivery in order: their names are numbered with five digits.
MOST_FILES = 99_999
FILE_BYTES = 1 << 30
GROUP_BYTES = 128 << 20


def deliver_in_order(df: DataFrame, order: Sequence[str], folder: str, least_files: int = 1) -> None:
    """Write ``df`` as one delivery whose row groups ascend in ``order``, by one shuffle into ranges.

    Later columns of ``order`` part the rows of a time that many share. NULLs come first.
    """
    files = min(MOST_FILES, max(least_files, planned_bytes(df) // FILE_BYTES))
    ranges = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranges.write.option("parquet.block.size", GROUP_BYTES).parquet(folder)
