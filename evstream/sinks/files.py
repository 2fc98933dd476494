"""Console, text, delimited and JSON document outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows as one text column, each behind ``label>``."""
    return df.select(F.concat(F.lit(f"{label}> "), F.concat_ws(",", *df.columns)).alias("value"))


def print_stream(df: DataFrame, label: str) -> DataStreamWriter:
    return labelled(df, label).writeStream.format("console").option("truncate", "false")


def write_text(df: DataFrame, path: str, files: int | None = None, column: str = "value") -> None:
    """Text files, one per task, or ``files`` of them for results of known size."""
    out = df.select(column)
    (out if files is None else out.coalesce(files)).write.text(path)


def write_delimited(df: DataFrame, path: str, sep: str = " ") -> None:
    """Delimited files; an existing folder is left alone and the write fails."""
    df.write.mode("errorifexists").option("sep", sep).csv(path)


def text_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.format("text").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def documents(df: DataFrame, **fields: str) -> DataFrame:
    """One JSON document per row, every field as text."""
    doc = F.struct(*[F.col(c).cast("string").alias(name) for name, c in fields.items()])
    return df.select(F.to_json(doc).alias("value"))
