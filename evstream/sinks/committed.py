"""A sink with a commit: the files of a job or micro-batch become visible together, or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

FILES, MANIFESTS = "files", "_manifests"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system on which Spark itself would find it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString())


def opened(url: str):
    """A file system and the path on it, in any process that pyarrow can reach it from."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url)


@dataclass
class TaskFile(WriterCommitMessage):
    name: str | None
    rows: int


class _Writing:
    """What both kinds of writer do: a file for each attempt of a task, then one manifest for all."""

    def __init__(self, url: str):
        self.url = url

    def write(self, iterator: Iterator) -> TaskFile:
        files, base = opened(self.url)
        name = f"{uuid.uuid4().hex}.txt"
        path = f"{base}/{FILES}/{name}"
        files.create_dir(f"{base}/{FILES}", recursive=True)
        n = 0
        try:
            with files.open_output_stream(path) as out:
                for row in iterator:
                    out.write(f"{row[0]}\n".encode())
                    n += 1
        except BaseException:
            files.delete_file(path)
            raise
        if n == 0:
            files.delete_file(path)
        return TaskFile(name if n else None, n)

    def publish(self, messages, manifest: str) -> None:
        files, base = opened(self.url)
        files.create_dir(f"{base}/{MANIFESTS}", recursive=True)
        held = {"files": [m.name for m in messages if m is not None and m.name], "rows": sum(m.rows for m in messages if m is not None)}
        temporary = f"{base}/{MANIFESTS}/_{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as out:
            out.write(json.dumps(held).encode())
        files.move(temporary, f"{base}/{MANIFESTS}/{manifest}.json")  # one step: old or new, never a part

    def remove(self, messages) -> None:
        files, base = opened(self.url)
        for m in messages:
            if m is not None and m.name:
                files.delete_file(f"{base}/{FILES}/{m.name}")


class _Batch(_Writing, DataSourceWriter):
    def __init__(self, url: str):
        super().__init__(url)
        self.job = uuid.uuid4().hex

    def commit(self, messages):
        self.publish(messages, f"job-{self.job}")

    def abort(self, messages):
        self.remove(messages)


class _Stream(_Writing, DataSourceStreamWriter):
    def commit(self, messages, batchId):
        # A batch that runs again puts its manifest in the place of the one before.
        self.publish(messages, f"batch-{batchId:09d}")

    def abort(self, messages, batchId):
        self.remove(messages)


def committed_text_sink(spark: SparkSession, name: str, folder: str) -> str:
    """Register a sink that writes the first column of its rows as lines.

    Every attempt of a task writes a file of its own; only the files named by a manifest count, and
    a manifest is written once all tasks of the job or micro-batch have ended well. The files of a
    failed job's finished tasks are removed; those of tasks that end after it failed stay, unseen, until
    :func:`remove_unnamed`. Read the lines with :func:`committed_lines`.
    """
    url = qualified(spark, folder)

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return _Batch(url)

        def streamWriter(self, schema, overwrite):
            return _Stream(url)

    spark.dataSource.register(Sink)
    return name


def _named(spark: SparkSession, folder: str) -> set[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFESTS}")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return set()
    schema = "files array<string>, rows bigint"
    manifests = spark.read.schema(schema).option("pathGlobFilter", "*.json").json(f"{folder}/{MANIFESTS}")
    return {f for r in manifests.select("files").toLocalIterator() for f in r["files"]}


def committed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The committed lines as one text column. The driver reads the names of the files, as it does
    when it lists a folder."""
    names = sorted(_named(spark, folder))
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{folder}/{FILES}/{n}" for n in names])


def remove_unnamed(spark: SparkSession, folder: str) -> int:
    """Remove files no manifest names, while nothing is being written; gives their number."""
    from pyarrow import fs

    named = _named(spark, folder)
    files, base = opened(qualified(spark, folder))
    lost = [f.path for f in files.get_file_info(fs.FileSelector(f"{base}/{FILES}", allow_not_found=True)) if f.base_name not in named]
    for path in lost:
        files.delete_file(path)
    return len(lost)
