"""Named queries whose rows go through a sink and are read back."""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from evstream.operators import partition, rows
from evstream.operators.common import cents
from evstream.plans import table_queries as tq
from evstream.plans.registry import ORACLE, query
from evstream.session import scratch_path
from evstream.sinks import files
from evstream.sinks.leveled import LeveledTable
from evstream.sources.readers import text_lines


@query("sink_documents_read_back", ORACLE["json_documents"])
def sink_documents_read_back(t):
    docs = files.documents(
        t.events.withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp"))),
        sensor_id="user_id", temperature="value", ts="ms",
    )
    path = scratch_path(t.spark, "documents")
    files.write_text(docs, path)
    return text_lines(t.spark, path)


@query("sink_delimited_read_back", """
    select user_id, event_type, cast(round(value * 100) as bigint) as cents from events""")
def sink_delimited_read_back(t):
    path = scratch_path(t.spark, "delimited")
    files.write_delimited(t.events.select("user_id", "event_type", cents("value").alias("cents")), path)
    schema = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("cents", T.LongType()),
    ])
    return rows.parse_delimited(text_lines(t.spark, path), schema, sep=" ")


@query("sink_key_value_snapshot", """
    select user_id, arg_max(event_id, (event_type, ts)) as event_id, max(event_type) as event_type
    from events group by user_id""")
def sink_key_value_snapshot(t):
    """A batch for each kind of event, in alphabetical order; a later batch replaces a key's value.
    Runs are merged on the way, and the version before the last merge says the same."""
    events = t.events.select("user_id", "event_id", "event_type", "ts")
    dealt = scratch_path(t.spark, "by-kind")
    number = F.dense_rank().over(Window.orderBy("event_type")) - 1
    kinds = saved_kinds(t, events, number, dealt)
    table = LeveledTable(t.spark, scratch_path(t.spark, "key-value"), ["user_id"], fan_in=2)
    for k in range(kinds):
        table.write_batch(t.spark.read.schema(events.schema).parquet(f"{dealt}/number={k}"), k, ["ts", "event_id"])
        table.compact(events.schema)
    return table.snapshot(events.schema).drop("ts")


def saved_kinds(t, events, number, folder) -> int:
    """Write the events once, a folder for each kind of event; gives the number of kinds."""
    kinds = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select("event_type", number.alias("number"))
    events.join(kinds, "event_type").select(*events.columns, "number").write.partitionBy("number").parquet(folder)
    return kinds.count()


@query("partition_spreads", """
    select count(*) as total, count(distinct event_id) as ids, true as seeded_again from events""")
def partition_spreads(t):
    """Random, keyed and merged spreading lose and double nothing; a seeded spread is repeatable."""
    ids = t.events.select("event_id", "user_id")
    tagged = lambda df, out: rows.with_partition(df, out)
    first = tagged(partition.shuffle_random(ids, 8, seed=7), "p")
    again = tagged(partition.shuffle_random(ids, 8, seed=7), "q").select("event_id", "q")
    merged = partition.rescale(partition.key_by(partition.forward(first), 8, "user_id"), 4)
    both = merged.join(again, "event_id")
    return both.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("event_id").alias("ids"),
        F.every(F.col("p") == F.col("q")).alias("seeded_again"),
    )
