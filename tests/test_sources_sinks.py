"""Readers and writers on files, topic-shaped rows and stand-in connections."""

import gzip
import json
import os
import sys

import pytest
from conftest import at, rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evstream import schemas
from evstream.operators import rows, windows
from evstream.sinks import files as out_files, keyed, partition, topics
from evstream.sources import readers
from evstream.streaming.runner import run_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# --- sources -------------------------------------------------------------------------------


def test_rows_and_sequence(spark):
    assert rows_of(readers.from_rows(spark, [("w", 1)], schemas.WORD)) == [("w", 1)]
    numbers = readers.from_sequence(spark, 0, 100)
    assert (numbers.count(), numbers.where("value > 10").count()) == (101, 90)


def test_text_files_folders_and_gzip(spark, tmp_path):
    write(tmp_path / "d" / "a.txt", "one two\nthree\n")
    write(tmp_path / "d" / "b.txt", "two")
    with gzip.open(tmp_path / "c.gz", "wt") as out:
        out.write("two\n" * 3)
    folder, zipped = readers.text_lines(spark, f"{tmp_path}/d"), readers.text_lines(spark, f"{tmp_path}/c.gz")
    assert rows_of(folder) == [("one two",), ("three",), ("two",)]
    assert zipped.rdd.getNumPartitions() > 1
    assert dict(rows_of(rows.word_count(folder.union(zipped), "value")))["two"] == 5


def test_line_stream_to_words(spark, tmp_path):
    write(tmp_path / "in" / "a.txt", "hello spark\n\nhello\n")
    lines = readers.line_stream(spark, path=f"{tmp_path}/in")
    words = rows.tokens(lines, "value", "whitespace")
    assert rows_of(run_to_table(words, "words")) == [("hello",), ("hello",), ("spark",)]
    # A socket reader is only declared here: the same call with another format.
    with pytest.raises(Exception, match="(?i)host"):
        readers.line_stream(spark, "socket", port=9)


def test_kafka_options_and_records(spark):
    options = readers.kafka_options("broker:9092", "log", group="g", start="earliest", discovery="5 seconds")
    assert options["subscribe"] == "log" and options["startingOffsets"] == "earliest"
    assert options["kafka.metadata.max.age.ms"] == "5000" and options["kafka.group.id"] == "g"
    with pytest.raises(ValueError):
        readers.kafka_options("b", "t", start="yesterday")
    records = spark.createDataFrame(
        [(None, bytearray(b'{"user_id":1,"page_id":2,"status":"success"}'), "log", 0, 7, at(1))],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    parsed = rows.parse_json(readers.kafka_text(records), schemas.PAGE_STATUS, keep=["offset"])
    assert rows_of(parsed) == [(7, 1, 2, "success")]


def test_json_table_through_sql_to_sink(spark, tmp_path):
    write(tmp_path / "in" / "a.json", "\n".join(
        json.dumps({"user_id": i, "page_id": 9, "status": s}) for i, s in enumerate(["success", "fail", "success"])
    ))
    readers.source_table(spark, "input_table", schemas.PAGE_STATUS, "text", path=f"{tmp_path}/in")
    chosen = spark.sql("select user_id, page_id, status from input_table where status = 'success'")
    shaped = topics.json_rows(chosen, key="user_id")
    assert shaped.dtypes == [("key", "string"), ("value", "string")]
    query = topics.insert_into(shaped.select("value"), "text", f"{tmp_path}/cp", path=f"{tmp_path}/out") \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    values = [json.loads(r[0]) for r in rows_of(spark.read.text(f"{tmp_path}/out"))]
    assert [v["user_id"] for v in values] == [0, 2] and values[0]["status"] == "success"


def test_startup_log_windows(spark):
    logs = [{"mid": "m", "ch": c, "ts": t, "area": "a"} for c, t in [("appstore", 1000), ("appstore", 9999), ("web", 1), ("appstore", 10000)]]
    lines = spark.createDataFrame([(json.dumps(r),) for r in logs], "value string")
    starts = rows.parse_json(lines, schemas.STARTUP_LOG).where("ch = 'appstore'")
    timed = starts.withColumn("at", F.timestamp_millis("ts"))
    out = windows.tumble(timed, "at", "10 seconds", ["ch"], F.count(F.lit(1)).alias("cnt"))
    assert rows_of(out, "ch", "cnt") == [("appstore", 1), ("appstore", 2)]


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", "t_student", "id", 1, 7, 3, user="u")
    assert (options["numPartitions"], options["lowerBound"], options["upperBound"]) == ("3", "1", "7")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id", 5, 5, 2)


def test_jdbc_poll_takes_changed_rows_of_its_range():
    options = readers.jdbc_options("jdbc:x", "t", "id", 1, 7, 3)
    poll = readers.jdbc_poll_options(options, "version", 40, 90)
    assert poll["dbtable"] == "(select * from t where version > 40 and version <= 90) polled"
    assert (poll["partitionColumn"], poll["lowerBound"], poll["upperBound"]) == ("version", "40", "91")
    with pytest.raises(ValueError):
        readers.jdbc_poll_options(options, "version", 90, 90)


def test_text_sink_replaces_what_a_task_wrote_before(spark, tmp_path):
    df = spark.range(20).repartition(2).select(F.col("id").cast("string").alias("value"))
    sink = partition.text_sink(spark, "evstream_test_text", f"{tmp_path}/out")
    for _ in range(2):
        df.write.format(sink).mode("append").save()
    assert sorted(int(r[0]) for r in rows_of(spark.read.text(f"{tmp_path}/out"))) == list(range(20))
    assert all(f.startswith("batch-000000000-part-") for f in os.listdir(tmp_path / "out"))


# --- file sinks ----------------------------------------------------------------------------


def test_text_and_delimited(spark, tmp_path):
    words = spark.createDataFrame([("a", 1), ("b", 2)], "word string, cnt int")
    out_files.write_text(words.select(F.concat_ws(":::", "word", "cnt").alias("value")), f"{tmp_path}/t", files=1)
    assert len([f for f in os.listdir(tmp_path / "t") if f.startswith("part")]) == 1
    assert rows_of(spark.read.text(f"{tmp_path}/t")) == [("a:::1",), ("b:::2",)]
    out_files.write_delimited(words, f"{tmp_path}/c")
    assert rows_of(spark.read.text(f"{tmp_path}/c")) == [("a 1",), ("b 2",)]
    with pytest.raises(Exception, match="(?i)exist"):
        out_files.write_delimited(words, f"{tmp_path}/c")


def test_labels_and_documents(spark):
    df = spark.createDataFrame([("s1", 35.8, 7)], "id string, t double, ts bigint")
    assert rows_of(out_files.labelled(df, "in")) == [("in> s1,35.8,7",)]
    docs = out_files.documents(df, sensor_id="id", temperature="t", ts="ts")
    assert rows_of(docs) == [('{"sensor_id":"s1","temperature":"35.8","ts":"7"}',)]


# --- custom and keyed sinks ----------------------------------------------------------------


def test_partition_sink_for_tables_and_streams(spark, tmp_path):
    folder = str(tmp_path)

    def open_():
        import tempfile

        return tempfile.NamedTemporaryFile("w", dir=folder, suffix=".tmp", delete=False)

    def put(held, row):
        held.write(f"{row['id']}\n")

    def close(held, ok):
        held.close()
        if ok:
            os.rename(held.name, held.name.replace(".tmp", ".done"))

    name = partition.partition_sink(spark, "evstream_test_lines", open_, put, close)
    spark.range(10).repartition(3).write.format(name).mode("append").save()
    write(tmp_path / "in" / "a.txt", "100\n101\n")
    ids = spark.readStream.text(f"{tmp_path}/in").select(F.col("value").alias("id"))
    ids.writeStream.format(name).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True) \
        .start().awaitTermination()
    lines = [line for f in os.listdir(folder) if f.endswith(".done") for line in open(f"{folder}/{f}").read().split()]
    assert sorted(map(int, lines)) == [*range(10), 100, 101]
    broken = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("id"))
    with pytest.raises(Exception):
        broken.write.format(name).mode("append").save()


def test_key_value_table(spark, tmp_path):
    table = keyed.KeyValueTable(f"{tmp_path}/kv", ["word"])
    schema = spark.createDataFrame([], "word string, n bigint, seq bigint").schema

    def batch(*data):
        return spark.createDataFrame(list(data), schema)

    table.write_batch(batch(("a", 1, 1), ("a", 2, 2), ("b", 1, 3)), 0, ["seq"])
    table.write_batch(batch(("a", 9, 4)), 1, ["seq"])
    table.write_batch(batch(("a", 3, 4)), 1, ["seq"])  # run again: replaces itself
    assert rows_of(table.snapshot(spark, schema), "word", "n") == [("a", 3), ("b", 1)]
    small = table.compact(spark, schema, f"{tmp_path}/kv2", 1)
    small.write_batch(batch(("b", 7, 5)), 2)
    assert rows_of(small.snapshot(spark, schema), "word", "n") == [("a", 3), ("b", 7)]


class FakeConnection:
    """Stands in for a database: the table is a file of JSON per key in a folder."""

    def __init__(self, folder):
        self.folder, self.pending, self.rowcount = folder, [], 0

    def cursor(self):
        return self

    def execute(self, sql, args):
        if sql.startswith("update"):
            name, age, key = args
            self.rowcount = int(os.path.exists(f"{self.folder}/{key}"))
        else:
            key, name, age = args
            self.rowcount = 1
        if self.rowcount:
            self.pending.append((sql.split()[0], key, name, age))

    def commit(self):
        for verb, key, name, age in self.pending:
            with open(f"{self.folder}/{key}", "w") as out:
                json.dump([verb, name, age], out)

    def rollback(self):
        pass

    def close(self):
        pass


def test_upsert(spark, tmp_path):
    folder = str(tmp_path)
    assert keyed.upsert_statements("t", ["id"], ["name", "age"]) == (
        "update t set name = ?, age = ? where id = ?",
        "insert into t (id, name, age) values (?, ?, ?)",
    )
    sink = keyed.upsert_sink(spark, "evstream_test_upsert", lambda: FakeConnection(folder), "t", ["id"], ["name", "age"])

    def students(*data):
        return spark.createDataFrame(list(data), "id int, name string, age int, seq int")

    keyed.upsert(students((1, "jack", 18, 1), (1, "jack", 19, 2), (2, "tom", 19, 3)), sink, ["id"], ["seq"])
    keyed.upsert(students((1, "jack", 20, 4)), sink, ["id"], ["seq"])
    held = {f: json.load(open(f"{folder}/{f}")) for f in sorted(os.listdir(folder))}
    assert held == {"1": ["update", "jack", 20], "2": ["insert", "tom", 19]}
