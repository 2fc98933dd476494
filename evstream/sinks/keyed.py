"""Keyed outputs: the latest value per key, as a table on files or in a database."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from evstream.operators.running import latest_per_key
from evstream.sinks.partition import partition_sink

BATCH = "batch_id"


class KeyValueTable:
    """A map from key to its latest value, fed by the micro-batches of a stream.

    Every batch is written to a folder of its own, so a batch that is run again replaces itself.
    :meth:`snapshot` gives the last value of each key; :meth:`compact` writes that down as the
    new start, so that the number of folders stays small.
    """

    def __init__(self, path: str, keys: Sequence[str]):
        self.path, self.keys = path.rstrip("/"), list(keys)

    def write_batch(self, df: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Write one batch; with ``order`` it is reduced to the last row per key first."""
        rows = latest_per_key(df, self.keys, order) if order else df
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def stream(self, df: DataFrame, checkpoint: str, order: Sequence[str] = (), mode: str = "update") -> DataStreamWriter:
        return (
            df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: self.write_batch(batch, batch_id, order))
        )

    def snapshot(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        held = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
        rows = spark.read.schema(held).parquet(self.path)
        return latest_per_key(rows, self.keys, [BATCH]).drop(BATCH)

    def compact(self, spark: SparkSession, schema: T.StructType, target: str, batch_id: int) -> "KeyValueTable":
        """The snapshot as a new table, standing for all batches up to ``batch_id``."""
        new = KeyValueTable(target, self.keys)
        new.write_batch(self.snapshot(spark, schema), batch_id)
        return new


def upsert_statements(table: str, keys: Sequence[str], values: Sequence[str]) -> tuple[str, str]:
    """The update by key, and the insert used when it changed nothing."""
    sets = ", ".join(f"{c} = ?" for c in values)
    where = " and ".join(f"{c} = ?" for c in keys)
    cols = [*keys, *values]
    marks = ", ".join("?" for _ in cols)
    return (
        f"update {table} set {sets} where {where}",
        f"insert into {table} ({', '.join(cols)}) values ({marks})",
    )


def upsert_sink(
    spark: SparkSession, name: str, connect: Callable, table: str, keys: Sequence[str], values: Sequence[str]
) -> str:
    """A sink that updates rows by key and inserts those that are new, one connection and one
    transaction per task. ``connect`` returns a database connection (DB-API, ``?`` marks).
    Running a task again gives the same table. Feed it one row per key (:func:`latest_per_key`),
    spread by key so that no two tasks hold the same one."""
    update, insert = upsert_statements(table, keys, values)
    keys, values = list(keys), list(values)

    def open_():
        connection = connect()
        return connection, connection.cursor()

    def write(held, row):
        cursor = held[1]
        key, value = [row[c] for c in keys], [row[c] for c in values]
        cursor.execute(update, (*value, *key))
        if cursor.rowcount == 0:
            cursor.execute(insert, (*key, *value))

    def close(held, ok):
        connection, cursor = held
        connection.commit() if ok else connection.rollback()
        cursor.close()
        connection.close()

    return partition_sink(spark, name, open_, write, close)


def upsert(df: DataFrame, sink: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Send the last row of each key to an upsert sink (use in ``foreachBatch`` for streams)."""
    latest_per_key(df, keys, order).write.format(sink).mode("append").save()


def append_rows(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Insert into a database table, in batches, from all tasks."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize="5000", **options
    ).save()
