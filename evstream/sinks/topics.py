"""Message topic output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


def topic_rows(df: DataFrame, value: Column | str, key: Column | str | None = None) -> DataFrame:
    """Rows in the shape a topic writer takes: text key (may be null) and text value."""
    as_text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    held = F.lit(None).cast("string") if key is None else as_text(key)
    return df.select(held.alias("key"), as_text(value).alias("value"))


def json_rows(df: DataFrame, *cols: str, key: str | None = None) -> DataFrame:
    return topic_rows(df, F.to_json(F.struct(*(cols or df.columns))), key)


def to_topic(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def insert_into(table: DataFrame, writer_format: str, checkpoint: str, **options) -> DataStreamWriter:
    """A query's result as the input of a declared sink."""
    return (
        table.writeStream.format(writer_format).outputMode("append")
        .option("checkpointLocation", checkpoint).options(**options)
    )
