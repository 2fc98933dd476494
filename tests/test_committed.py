"""Sinks that commit, versions of a key-value table, delivered row groups, table functions."""

import os
import random
import sys

import pytest
from conftest import rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from evstream.operators.running import latest_per_key
from evstream.operators.table_functions import greedy_batches
from evstream.sinks.committed import committed_lines, committed_text_sink, qualified, remove_unnamed
from evstream.sinks.leveled import LeveledTable
from evstream.sources.groups import deliver_in_order, row_groups
from evstream.streaming.runner import Restart, run_stream, run_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS = "k string, v bigint, seq bigint"


def lines(folder, spark):
    return sorted(int(r[0]) for r in committed_lines(spark, folder).collect())


def test_paths_are_those_of_spark(spark, tmp_path):
    assert qualified(spark, f"{tmp_path}/x") == f"file:{tmp_path}/x"
    assert qualified(spark, f"file://{tmp_path}/x") == f"file:{tmp_path}/x"


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    folder = f"{tmp_path}/out"
    sink = committed_text_sink(spark, "evstream_test_committed", folder)
    numbers = spark.range(100).repartition(4, "id")
    fails = F.when(F.col("id") == 77, F.raise_error(F.lit("planned"))).otherwise(F.col("id").cast("string"))
    with pytest.raises(Exception, match="planned"):
        numbers.select(fails.alias("value")).write.format(sink).mode("append").save()
    assert lines(folder, spark) == []
    numbers.select(F.col("id").cast("string").alias("value")).write.format(sink).mode("append").save()
    numbers.limit(0).select(F.col("id").cast("string").alias("value")).write.format(sink).mode("append").save()
    assert lines(folder, spark) == list(range(100))
    # A file no manifest names, as a lost attempt leaves it, does not count.
    with open(f"{folder}/files/lost.txt", "w") as out:
        out.write("5\n")
    assert lines(folder, spark) == list(range(100))
    assert remove_unnamed(spark, folder) >= 1 and lines(folder, spark) == list(range(100))
    assert len(os.listdir(f"{folder}/files")) == 4 and remove_unnamed(spark, folder) == 0


def test_micro_batches_are_committed_once(spark, tmp_path):
    folder, source = f"{tmp_path}/out", f"{tmp_path}/in"
    sink = committed_text_sink(spark, "evstream_test_committed_stream", folder)
    for k in range(3):
        spark.range(10 * k, 10 * k + 10, numPartitions=2).write.mode("append").json(source)
    starts = []

    def build():
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 2).json(source)
        value = F.col("id").cast("string")
        if not starts:
            value = F.when(F.col("id") == 25, F.raise_error(F.lit("planned"))).otherwise(value)
        starts.append(1)
        return (stream.select(value.alias("value")).writeStream.format(sink)
                .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True))

    run_stream(build, Restart.fixed(1, 0))
    assert len(starts) == 2 and lines(folder, spark) == list(range(30))
    names = sorted(f for f in os.listdir(f"{folder}/_manifests") if f.endswith(".json"))
    assert names == [f"batch-{k:09d}.json" for k in range(len(names))] and len(names) >= 2


def test_levels(spark, tmp_path):
    table, schema = LeveledTable(spark, f"{tmp_path}/kv", ["k"], fan_in=3), spark.createDataFrame([], PAIRS).schema
    assert rows_of(table.snapshot(schema)) == [] and table.compact(schema) == [] and table.versions() == []
    r, held = random.Random(6), {}
    for b in range(14):
        rows = [(f"k{r.randint(0, 9)}", r.randint(0, 99), i) for i in range(r.randint(1, 6))]
        table.write_batch(spark.createDataFrame(rows, PAIRS), b, ["seq"])
        held |= {k: v for k, v, _ in rows}
        made = table.compact(schema)
        # A merge joins the runs of one level alone, and never the batch that may come again.
        assert all(m.last < b for m in made) and len([x for x in table.runs() if x.level == 0]) <= 4
        assert rows_of(table.snapshot(schema), "k", "v") == sorted(held.items())
    spans = sorted((x.first, x.last) for x in table.runs())
    assert [s[0] for s in spans] == [0, *[s[1] + 1 for s in spans[:-1]]] and spans[-1][1] == 13
    assert max(x.level for x in table.runs()) == 2


def test_batches_that_come_again_and_readers_of_old_versions(spark, tmp_path):
    table, schema = LeveledTable(spark, f"{tmp_path}/kv", ["k"], fan_in=2), spark.createDataFrame([], PAIRS).schema
    batch = lambda *rows: spark.createDataFrame(list(rows), PAIRS)
    table.write_batch(batch(("a", 1, 1), ("a", 2, 2), (None, 8, 1)), 0, ["seq"])
    table.write_batch(batch(("a", 9, 3)), 1, ["seq"])
    table.write_batch(batch(("a", 3, 3), ("b", 4, 3)), 1, ["seq"])  # again: replaces itself
    version = max(table.versions())
    before = table.snapshot(schema)
    table.write_batch(batch(("b", 7, 4)), 2, ["seq"])
    assert len(table.compact(schema)) == 1
    table.write_batch(batch(("a", 0, 0)), 0, ["seq"])  # merged meanwhile: left alone
    assert rows_of(before, "k", "v") == rows_of(table.snapshot(schema, version), "k", "v") == [("a", 3), ("b", 4), (None, 8)]
    assert rows_of(table.snapshot(schema), "k", "v") == [("a", 3), ("b", 7), (None, 8)]
    table.clean(keep=1)
    assert len(table.versions()) == 1 and len(os.listdir(f"{tmp_path}/kv/runs")) == len(table.runs())
    assert rows_of(table.snapshot(schema), "k", "v") == [("a", 3), ("b", 7), (None, 8)]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    table = LeveledTable(spark, f"{tmp_path}/kv", ["k"])
    table.write_batch(spark.createDataFrame([("a", 1, 1)], PAIRS), 0)
    monkeypatch.setattr(table, "versions", lambda: [])
    with pytest.raises(RuntimeError, match="another"):
        table._switch([])


def test_offsets_follow_delivered_row_groups(spark, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/job"
    numbers = lambda a, b: spark.range(a, b, numPartitions=2).withColumn("extra", F.lit("x"))
    numbers(0, 40).write.option("parquet.block.row.count.limit", 7).parquet(f"{source}/000")
    stream = row_groups(spark, source, spark.range(0).schema)
    assert sorted(r[0] for r in rows_of(run_to_table(stream, "groups", folder=folder))) == list(range(40))
    numbers(40, 50).write.parquet(f"{source}/001")
    os.makedirs(f"{source}/002")  # a write that has not ended
    numbers(90, 95).toPandas().to_parquet(f"{source}/002/part-0.parquet")
    assert sorted(r[0] for r in rows_of(run_to_table(stream, "groups", folder=folder))) == list(range(50))
    assert sorted(r[0] for r in rows_of(run_to_table(stream, "groups", folder=folder))) == list(range(50))
    open(f"{source}/002/_SUCCESS", "w").close()
    assert sorted(r[0] for r in rows_of(run_to_table(stream, "groups", folder=folder))) == [*range(50), *range(90, 95)]


def test_row_groups_are_dealt_to_tasks(tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    from evstream.sources.groups import GroupReader

    for d in ("a", "b"):
        os.makedirs(f"{tmp_path}/{d}")
        parquet.write_table(pa.table({"id": list(range(10))}), f"{tmp_path}/{d}/x.parquet", row_group_size=2)
        open(f"{tmp_path}/{d}/_SUCCESS", "w").close()
    reader = GroupReader(f"file://{tmp_path}", T.StructType().add("id", "long"), 2)
    end = reader.latestOffset()
    assert end == {"file": "b/x.parquet", "groups": 5}
    parts = reader.partitions({"file": "a/x.parquet", "groups": 3}, end)
    assert [(p.path, p.first, p.last) for p in parts] == [("a/x.parquet", 3, 5), ("b/x.parquet", 0, 2), ("b/x.parquet", 2, 4), ("b/x.parquet", 4, 5)]
    assert [v for b in reader.read(parts[0]) for v in b.column("id").to_pylist()] == [6, 7, 8, 9]
    assert reader.partitions(end, end) == []


def test_bytes_admit_row_groups_of_any_size(tmp_path):
    """Small files share a micro-batch, a large one is cut between its row groups, and one row group
    larger than the limit goes alone."""
    import pyarrow as pa
    from pyarrow import parquet

    from evstream.sources.groups import GroupReader

    values = random.Random(4)
    for name, rows, group in (("a", 10, 10), ("b", 10, 10), ("c", 4000, 1000), ("d", 20000, 20000), ("e", 10, 10)):
        table = pa.table({"id": [values.getrandbits(60) for _ in range(rows)]})
        parquet.write_table(table, f"{tmp_path}/{name}.parquet", row_group_size=group, compression="none", use_dictionary=False)
    open(f"{tmp_path}/_SUCCESS", "w").close()
    reader = GroupReader(f"file://{tmp_path}", T.StructType().add("id", "long"), 1, None, 20_000)
    ends = []
    while (end := reader.latestOffset()) != reader.place:
        reader.partitions(reader.place, end)
        ends.append((end["file"][0], end["groups"]))
    assert ends == [("c", 2), ("c", 4), ("d", 1), ("e", 1)]


def test_a_limit_cuts_row_groups_into_micro_batches(spark, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/job"
    shuffled = spark.range(1000, numPartitions=3).select((F.col("id") * 7919 % 1000).alias("id"))
    deliver_in_order(shuffled, ["id"], f"{source}/000", 9)
    stream = row_groups(spark, source, shuffled.schema, groups_per_batch=2)
    told = lambda: run_to_table(stream, "limited", folder=folder, limited=True)
    batches = lambda: len([f for f in os.listdir(f"{folder}/checkpoint/offsets") if f.isdigit()])
    assert sorted(r[0] for r in rows_of(told())) == list(range(1000))
    assert batches() == 5
    # Every micro-batch holds what comes after the one before it.
    files = told().select("id", F.input_file_name().alias("f")).groupBy("f").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    spans = sorted((r["a"], r["b"]) for r in files.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
    # A new start goes on where the last one ended, within the limit too.
    deliver_in_order(spark.range(1000, 1100), ["id"], f"{source}/001", 3)
    assert sorted(r[0] for r in rows_of(told())) == list(range(1100))
    assert batches() == 7
    assert sorted(r[0] for r in rows_of(told())) == list(range(1100))
    assert batches() == 7


def test_a_failed_micro_batch_of_a_limited_stream_is_done_again(spark, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/job"
    deliver_in_order(spark.range(400), ["id"], f"{source}/000", 8)
    stream, starts = row_groups(spark, source, spark.range(0).schema, groups_per_batch=2), []

    def build():
        bad = F.when(F.col("id") == 250, F.raise_error(F.lit("planned")).cast("long")).otherwise(F.col("id"))
        starts.append(1)
        rows = stream.select(bad.alias("id")) if len(starts) == 1 else stream
        writer = rows.writeStream.format("parquet").option("path", f"{folder}/table")
        return writer.option("checkpointLocation", f"{folder}/checkpoint")

    run_stream(build, Restart.fixed(1, 0), drain=True)
    assert len(starts) == 2
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/table").collect()) == list(range(400))


def test_state_of_a_stream_in_order_is_what_is_open(spark, tmp_path):
    """240 hours of events in six micro-batches: the state holds the windows of one or two of them."""
    source, folder = f"{tmp_path}/in", f"{tmp_path}/job"
    hour = F.timestamp_seconds(F.call_function("div", F.col("id") * 7919 % 4800, F.lit(20)) * 3600)
    deliver_in_order(spark.range(4800).select(hour.alias("ts")), ["ts"], f"{source}/000", 24)
    stream = row_groups(spark, source, T.StructType().add("ts", "timestamp"), groups_per_batch=4)
    counts = stream.withWatermark("ts", "1 millisecond").groupBy(F.window("ts", "1 hour")).count()
    query = (counts.select("window.start", "count").writeStream.format("parquet").option("path", f"{folder}/table")
             .option("checkpointLocation", f"{folder}/checkpoint").start())
    query.processAllAvailable()
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    query.stop()
    told = [r["count"] for r in spark.read.parquet(f"{folder}/table").collect()]
    assert len(held) >= 6 and max(held) <= 90
    # The last events fall on 239:00, which ends the window before theirs but for the bound.
    assert len(told) == 238 and set(told) == {20}


def test_greedy_batches(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.randint(0, 50), i, r.choice([None, 1, 5, 30, 200])) for i in range(400)]
    want = []
    for key in ("a", "b", None):
        number, open_ = 0, None
        for _, _, i, v in sorted((x for x in rows if x[0] == key), key=lambda x: (x[1], x[2])):
            if open_ and open_[4] + (v or 0) > 60:
                want.append(tuple(open_))
                open_ = None
            if not open_:
                number += 1
                open_ = [key, number, i, 0, 0]
            open_[3] += 1
            open_[4] += v or 0
        want.append(tuple(open_))
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint")
    got = rows_of(greedy_batches(df, "k", ["t", "id"], "v", 60))
    assert got == sorted(want, key=lambda x: tuple((c is None, str(type(c)), c) for c in x))
    assert greedy_batches(df.limit(0), "k", ["t", "id"], "v", 60).count() == 0
    assert latest_per_key(df, ["k"], ["id"]).count() == 3
