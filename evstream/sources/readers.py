"""Rows from memory, files, sockets, message topics, JSON tables and databases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from evstream.functions.time import micros
from evstream.operators.partition import widened
from evstream.operators.rows import parse_json


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A small table given in the program."""
    return spark.createDataFrame(list(rows), schema)


def from_sequence(spark: SparkSession, first: int, last: int, out: str = "value") -> DataFrame:
    """The whole numbers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", out)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a file, of all files of a folder, or of gzip files. A gzip file is
    read by one task, so few of them are spread out again."""
    lines = spark.read.text(path)
    return widened(lines) if path.endswith(".gz") else lines


def line_stream(spark: SparkSession, format: str = "text", **options) -> DataFrame:
    """Lines as they arrive: ``socket`` (host, port) or ``text`` (path of a folder)."""
    reader = spark.readStream.format(format)
    if format == "text":
        path = options.pop("path")
        return reader.options(**options).load(path)
    return reader.options(**options).load()


def kafka_options(
    servers: str, topic: str, group: str | None = None, start: str = "latest", discovery: str = "5 seconds"
) -> dict[str, str]:
    """Reader options for a topic. Offsets live in the query's checkpoint; the group id is for
    monitoring. New partitions are found within ``discovery``."""
    if start not in ("latest", "earliest") and not start.startswith("{"):
        raise ValueError(f"start must be latest, earliest or offsets as JSON: {start!r}")
    millis = str(micros(discovery) // 1000)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "kafka.metadata.max.age.ms": millis,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return kafka_text(spark.readStream.format("kafka").options(**options).load())


def kafka_text(records: DataFrame) -> DataFrame:
    """Topic records with the value as text, beside their position and time."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("record_time"),
    )


def source_table(
    spark: SparkSession, name: str, schema: T.StructType, format: str, **options
) -> DataFrame:
    """A named stream table of JSON documents over a topic or a folder of lines."""
    if format == "kafka":
        records = kafka_stream(spark, options)
    else:
        records = line_stream(spark, format, **options)
    table = parse_json(records, schema)
    table.createOrReplaceTempView(name)
    return table


def jdbc_options(
    url: str, table: str, column: str, lower: int, upper: int, parts: int, **more: str
) -> dict[str, str]:
    """Options of a read in ``parts`` ranges of a numeric column: every row is read once."""
    if parts < 1 or upper <= lower:
        raise ValueError("a partitioned read needs lower < upper and at least one part")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
        "fetchsize": "10000",
        **more,
    }


def jdbc_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_poll_options(options: Mapping[str, str], changed: str, after: int, upto: int) -> dict[str, str]:
    """Options of a poll: the rows whose ``changed`` column, a whole number that rises with every
    insert and update (a version, a time in milliseconds), is above ``after`` and at most
    ``upto``. The next poll starts at ``upto``; the ranges of tasks are those of the poll."""
    if upto <= after:
        raise ValueError("a poll needs after < upto")
    where = f"{changed} > {int(after)} and {changed} <= {int(upto)}"
    return {
        **options,
        "dbtable": f"(select * from {options['dbtable']} where {where}) polled",
        "partitionColumn": changed,
        "lowerBound": str(int(after)),
        "upperBound": str(int(upto) + 1),
    }


def jdbc_changes(spark: SparkSession, options: Mapping[str, str], changed: str, after: int, upto: int) -> DataFrame:
    """The rows inserted or changed since the last poll, as they are now."""
    return jdbc_table(spark, jdbc_poll_options(options, changed, after, upto))
