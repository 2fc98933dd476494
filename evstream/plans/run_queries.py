"""Named queries that declare tables, number rows, write through own sinks, and restart."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from evstream.operators import partition, rows
from evstream.operators.table_functions import greedy_batches
from evstream.plans import table_queries as tq
from evstream.plans.registry import query
from evstream.plans.stream_queries import drained
from evstream.schemas import TABLES
from evstream.session import prepare_streaming, scratch_path
from evstream.sinks import topics
from evstream.sinks.committed import committed_lines, committed_text_sink
from evstream.sinks.partition import text_sink
from evstream.sources.groups import row_groups
from evstream.sources.readers import source_table, text_lines
from evstream.streaming.runner import Restart, run_stream, run_to_table

VISIT = T.StructType([T.StructField(n, t) for n, t in (
    ("event_id", T.LongType()), ("user_id", T.LongType()), ("event_type", T.StringType()), ("value", T.DoubleType()))])


def _declared(t, name):
    """The events as a named stream table over JSON lines."""
    path = scratch_path(t.spark, name)
    t.events.select(F.to_json(F.struct(*VISIT.names))).write.text(path)
    return source_table(prepare_streaming(t.spark), name, VISIT, "text", path=path)


@query("stream_declared_table", """
    select event_id, user_id, value from events where event_type = 'view' and value > 20""")
def stream_declared_table(t):
    _declared(t, "declared_events")
    sql = "select event_id, user_id, value from declared_events where event_type = 'view' and value > 20"
    return drained(t, t.spark.sql(sql), "declared")


@query("stream_insert_into", "select user_id, event_type, event_id from events where value <= 20")
def stream_insert_into(t):
    """A query over one declared table as the input of another, which is read back."""
    wanted = _declared(t, "insert_source").where("value <= 20").select("user_id", "event_type", "event_id")
    folder = scratch_path(t.spark, "insert")
    writer = topics.insert_into(wanted, "json", f"{folder}/checkpoint", path=f"{folder}/table")
    run_stream(lambda: writer.trigger(availableNow=True))
    return t.spark.read.schema(wanted.schema).json(f"{folder}/table")


@query("global_partition", "select event_type, count(*) as cnt, cast(0 as int) as part from events group by event_type")
def global_partition(t):
    """A row per type, all in the first partition."""
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return rows.with_partition(partition.to_first(counts), "part")


LANES = 4


@query("numbered_rows", f"""
    select cast(event_id % {LANES} as int) as lane, event_id // {LANES} as place, event_id, event_type from events""")
def numbered_rows(t):
    """The events by a source that keeps its place among the row groups of delivered files: two
    deliveries are there for the first run; of the two that follow, the first start fails."""
    folder = scratch_path(prepare_streaming(t.spark), "groups")
    events = t.events.select("event_id", "event_type")
    ids = events.agg(F.coalesce(F.max("event_id"), F.lit(0)) + 1).first()[0]
    delivery = F.call_function("div", F.col("event_id") * 4, F.lit(ids))
    numbers = row_groups(t.spark, f"{folder}/source", events.schema).select(
        (F.col("event_id") % LANES).cast("int").alias("lane"), F.call_function("div", F.col("event_id"), F.lit(LANES)).alias("place"),
        "event_id", "event_type")
    for k in range(4):
        events.where(delivery == k).write.parquet(f"{folder}/source/{k:03d}")
        if k == 1:
            run_to_table(numbers, "numbered", folder=folder)
    starts = []

    def build():
        bad = F.raise_error(F.lit("planned failure of the first start")).cast("string")
        held = numbers.withColumn("event_type", F.when(F.col("event_id") % 97 == 5, bad).otherwise(F.col("event_type")))
        starts.append(1)
        return (
            (held if len(starts) == 1 else numbers).writeStream.format("parquet").option("path", f"{folder}/table")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        )

    run_stream(build, Restart.fixed(1, 0))
    return t.spark.read.schema(numbers.schema).parquet(f"{folder}/table")


@query("custom_sink_read_back", "select event_id, user_id, event_type, value from events")
def custom_sink_read_back(t):
    folder = scratch_path(t.spark, "custom-sink")
    sink = text_sink(t.spark, "evstream_text", folder)
    t.events.select(F.to_json(F.struct(*VISIT.names)).alias("value")).write.format(sink).mode("append").save()
    return rows.parse_json(text_lines(t.spark, folder), VISIT)


@query("committed_sink_read_back", "select event_id, user_id, event_type, value from events")
def committed_sink_read_back(t):
    """A job that fails in one task leaves nothing; the same job without the fault comes whole."""
    folder = scratch_path(t.spark, "committed-sink")
    sink = committed_text_sink(t.spark, "evstream_committed", folder)
    lines = t.events.repartition(4, "event_id").select("event_id", F.to_json(F.struct(*VISIT.names)).alias("value"))
    bad = F.when(F.col("event_id") % 97 == 5, F.raise_error(F.lit("planned failure of a task")).cast("string"))
    try:
        lines.select(F.coalesce(bad, F.col("value")).alias("value")).write.format(sink).mode("append").save()
    except PySparkException:
        pass
    lines.select("value").write.format(sink).mode("append").save()
    return rows.parse_json(committed_lines(t.spark, folder), VISIT)


@query("table_function_batches", f"""
    with recursive e as (select user_id, event_id, {tq.SQL_K} as k, row_number() over (partition by user_id order by ts, event_id) as rn
                         from events),
    b as (select user_id, rn, event_id, 1 as batch, k as held from e where rn = 1
          union all select e.user_id, e.rn, e.event_id, case when b.held + e.k > 150 then b.batch + 1 else b.batch end,
                           case when b.held + e.k > 150 then e.k else b.held + e.k end
          from b join e on e.user_id = b.user_id and e.rn = b.rn + 1)
    select user_id, cast(batch as bigint) as batch, min(event_id) as first_event_id, count(*) as n, cast(max(held) as bigint) as total
    from b group by user_id, batch""")
def table_function_batches(t):
    """Each user's events in order, cut into batches whose values stay under a cap."""
    return greedy_batches(t.events.withColumn("k", tq.k_()), "user_id", ["ts", "event_id"], "k", 150)


@query("stream_restart", "select distinct user_id, event_type from events")
def stream_restart(t):
    """The first start fails on some rows; the second goes on with its state and offsets."""
    folder = scratch_path(prepare_streaming(t.spark), "restart")
    t.events.repartitionByRange(4, "event_id").write.parquet(f"{folder}/source")
    starts = []

    def build():
        events = t.spark.readStream.schema(TABLES["events"]).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source")
        if not starts:
            bad = F.raise_error(F.lit("planned failure of the first start")).cast("bigint")
            events = events.withColumn("user_id", F.when(F.col("event_id") % 97 == 5, bad).otherwise(F.col("user_id")))
        starts.append(1)
        return (
            events.select("user_id", "event_type").dropDuplicates()
            .writeStream.format("parquet").option("path", f"{folder}/table")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        )

    run_stream(build, Restart.fixed(1, 0))
    return t.spark.read.schema("user_id bigint, event_type string").parquet(f"{folder}/table")
