"""Row-wise work: parsing lines, tokenising, routing, merging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from evstream.functions import text
from evstream.operators.partition import widened

TAG = "tag"
BAD = "_bad"


def parse_delimited(
    df: DataFrame, schema: T.StructType, sep: str = ",", line: str = "value", on_error: str = "fail"
) -> DataFrame:
    """Lines to typed rows: split, trim, cast by position; surplus fields are ignored.

    ``on_error``: ``fail`` stops the query at a bad line, ``drop`` leaves it out, ``quarantine``
    keeps every line with the text of the bad ones in ``_bad`` and nulls elsewhere.
    """
    if on_error not in ("fail", "drop", "quarantine"):
        raise ValueError(on_error)
    return _parse(df, schema, sep, line, on_error, list(range(len(schema))))


def parse_positions(
    df: DataFrame,
    schema: T.StructType,
    positions: Sequence[int],
    sep: str = " ",
    line: str = "value",
    on_error: str = "fail",
) -> DataFrame:
    """As :func:`parse_delimited` with the field number of each column given."""
    return _parse(df, schema, sep, line, on_error, list(positions))


def _parse(df, schema, sep, line, on_error, positions):
    strict = on_error == "fail"
    pattern = "\\Q" + sep + "\\E"
    text_of = F.col(line)
    if strict:  # a missing line is a bad one
        text_of = F.coalesce(text_of, F.raise_error(F.lit("line is NULL")).cast("string"))
    parts = df.withColumn("_f", F.split(text_of, pattern))
    fields = [
        text.field(F.col("_f"), pos, f.dataType.simpleString(), strict).alias(f.name)
        for pos, f in zip(positions, schema)
    ]
    if strict:
        return parts.select(*fields)
    broken = F.col(BAD).isNull()
    for f in schema:
        broken = broken | F.col(f.name).isNull()
    parsed = parts.select(*fields, F.col(line).alias(BAD)).withColumn(
        BAD, F.when(broken, F.coalesce(F.col(BAD), F.lit("")))
    )
    if on_error == "drop":
        return parsed.where(F.col(BAD).isNull()).drop(BAD)
    return parsed


def parse_access_log(df: DataFrame, line: str = "value") -> DataFrame:
    """Blank-separated access-log lines to (ip, user_id, event_time, method, url).

    Fields 0, 1, 3, 5 and 6 are used; the zone in field 4 is ignored and times are taken as
    UTC, written ``dd/MM/yyyy:HH:mm:ss``.
    """
    f = F.split(F.col(line), " ")
    return df.select(
        F.trim(f[0]).alias("ip"),
        F.trim(f[1]).alias("user_id"),
        F.to_timestamp(F.trim(f[3]), "dd/MM/yyyy:HH:mm:ss").cast("timestamp_ntz").alias("event_time"),
        F.trim(f[5]).alias("method"),
        F.trim(f[6]).alias("url"),
    )


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to typed columns."""
    return df.select(*keep, F.from_json(F.col(value), schema).alias("_j")).select(*keep, "_j.*")


def tokens(df: DataFrame, column: str, how: str = "space", out: str = "word") -> DataFrame:
    """One row per word of a text column: ``space``, ``whitespace`` or ``lowered`` rule."""
    df = widened(df.select(column))
    if how == "space":
        per_line = df.select(F.explode(text.lines(F.col(column))).alias("_line"))
        line = text.without_last(F.col("_line"), "\r")
        per_line = per_line.select(line.alias("_line"))
        return per_line.select(F.explode(text.words_on_space(F.col("_line"))).alias(out))
    rule = {"whitespace": text.words_on_whitespace, "lowered": text.words_lowered}[how]
    # The filter runs in the same generated code as the explode, a filter in the array does not.
    return df.select(F.explode(rule(F.col(column))).alias(out)).where(F.col(out) != "")


def word_count(df: DataFrame, column: str, how: str = "space") -> DataFrame:
    return tokens(df, column, how).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def tag_rows(df: DataFrame, rules: Mapping[str, Column], otherwise: str = "main") -> DataFrame:
    """Name the output each row goes to: the first rule that holds, else ``otherwise``."""
    tag = None
    for name, rule in rules.items():
        tag = F.when(rule, F.lit(name)) if tag is None else tag.when(rule, F.lit(name))
    return df.withColumn(TAG, F.lit(otherwise) if tag is None else tag.otherwise(F.lit(otherwise)))


def tagged(df: DataFrame, *names: str) -> DataFrame:
    """The rows sent to one or several of the named outputs."""
    return df.where(F.col(TAG).isin(*names)).drop(TAG)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set union; works on streams too."""
    both = left.unionByName(right)
    return both.dropDuplicates() if both.isStreaming else both.distinct()


def connect(left: DataFrame, right: DataFrame, left_map, right_map) -> DataFrame:
    """Merge two inputs of different shape, each mapped by its own function."""
    return left_map(left).unionByName(right_map(right), allowMissingColumns=True)


def with_partition(df: DataFrame, out: str = "partition") -> DataFrame:
    """The number of the partition a row is processed in."""
    return df.withColumn(out, F.spark_partition_id())
