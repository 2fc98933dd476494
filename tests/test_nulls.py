"""NULL values, odd durations and functions whose grouping matters."""

import sys

import pytest
from conftest import rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evstream.functions.time import micros
from evstream.operators import rows, running, windows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BIG = 9007199254740993  # 2^53 + 1: a double cannot hold it


def numbered(spark, *values, kind="bigint"):
    return spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], f"k string, id bigint, v {kind}")


@pytest.mark.parametrize("text", ["1.5 hours", "an hour", "", "5", "1 hour and 2 minutes", "3 weeks"])
def test_durations_not_understood(text):
    with pytest.raises(ValueError):
        micros(text)


def test_compound_durations():
    assert micros("1 hour 30 minutes") == 5_400_000_000
    assert micros("-5 seconds") == -5_000_000


def reduced(spark, combine, associative, *values):
    out = running.running_reduce(numbered(spark, *values), ["k"], ["id"], ["v", "id"], combine, associative)
    return [r[0] for r in rows_of(out.orderBy("id"), "reduced_id", "id")], rows_of(out, "id", "reduced_v")


def last_and_count(x, y):
    return (y[0], x[1] + 1)


def test_reduce_keeps_null_and_large_numbers(spark):
    _, got = reduced(spark, last_and_count, False, BIG, None, 3)
    assert got == [(0, BIG), (1, None), (2, 3)]


def test_reduce_carries_null_fields_over_slices(spark, sliced):
    add = lambda x, y: (None, x[1] + y[1])
    data = spark.createDataFrame([("a", i, None, 1) for i in range(30)], "k string, id bigint, v bigint, n bigint")
    out = running.running_reduce(data, ["k"], ["id"], ["v", "n"], add, associative=True)
    assert [r[1] for r in rows_of(out, "id", "reduced_n")] == list(range(1, 31))


def test_reduce_that_is_not_associative_is_the_same_when_keys_are_cut(spark, sliced):
    data = numbered(spark, *range(12))
    out = running.running_reduce(data, ["k"], ["id"], ["v"], lambda x, y: (x[0] + 1,))
    assert [r[1] for r in rows_of(out, "id", "reduced_v")] == list(range(12))


def test_changelog_passes_over_nulls(spark):
    out = running.changelog(numbered(spark, None, 5, None, 3), ["k"], ["id"], "v")
    assert rows_of(out, "id", "inserted", "total") == [(1, True, 5), (3, False, 5), (3, True, 8)]


def test_sliding_sum_of_nulls_is_null(spark):
    df = numbered(spark, None, 5).withColumn("ts", F.timestamp_seconds(F.col("id") * 100).cast("timestamp_ntz"))
    for extremes in ({}, {"extremes": {"most": ("max", "v")}}):
        out = windows.slide(df, "ts", "10 seconds", "10 seconds", ["k"], sums={"s": "v"}, **extremes)
        assert rows_of(out, "s") == [(5,), (None,)]


def test_null_lines(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T

    df = spark.createDataFrame([("a,1",), (None,), ("b,x",)], "value string")
    schema = T.StructType([T.StructField("n", T.StringType()), T.StructField("i", T.IntegerType())])
    assert rows_of(rows.parse_delimited(df, schema, on_error="drop")) == [("a", 1)]
    assert rows_of(rows.parse_delimited(df, schema, on_error="quarantine"), "_bad") == [("",), ("b,x",), (None,)]
    with pytest.raises(PySparkException):
        rows.parse_delimited(df.where("value is null"), schema, on_error="fail").collect()
