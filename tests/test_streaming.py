"""Streams of several files: state across batches, watermarks, late rows, restarts."""

import os

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F

from evstream.operators import joins, late, rows, windows
from evstream.operators.patterns import Step
from evstream.sources.offsets import OffsetSource
from evstream.streaming import jobs, processors
from evstream.streaming.runner import Closing, Restart, run_stream, run_to_table

SCHEMA = "user string, id bigint, ts timestamp_ntz, kind string, v bigint"


class Files:
    """A folder of JSON files read one per micro-batch, in the order they were added."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0

    def add(self, *data):
        """Rows (user, id, seconds, kind, value)."""
        df = self.spark.createDataFrame([(u, i, at(s), k, v) for u, i, s, k, v in data], SCHEMA)
        lines = [r[0] for r in df.select(F.to_json(F.struct("*"))).collect()]
        path = os.path.join(self.folder, f"{self.n:03d}.json")
        with open(path, "w") as out:
            out.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.n * 10,) * 2)
        self.n += 1
        return self

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(self.folder)

    def timed(self, bound="0 seconds"):
        return jobs.event_time(self.stream(), "ts", bound)


@pytest.fixture
def files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return Files(spark, folder)


def drain(df, name="t", **args):
    return run_to_table(df, name, **args)


def kind(name):
    return F.col("kind") == name


def test_window_results_over_batches(files):
    files.add(("a", 1, 1, "", 1)).add(("a", 2, 9, "", 2)).add(("a", 3, 12, "", 4)).add(("a", 4, 31, "", 8))
    out = windows.tumble(files.timed(), "ts", "10 seconds", ["user"], F.sum("v").alias("s"))
    assert rows_of(drain(jobs.plain_times(out)), "window_start", "s") == [(at(0), 3), (at(10), 4)]


def test_late_row_within_bound_corrects_and_beyond_is_dropped(spark, files):
    # The watermark is 20 - 5 = 15 after the second file. Spark drops rows by the mark of the
    # batch before, so the third file may still correct the first window, the fourth may not.
    files.add(("a", 1, 12, "", 1)).add(("a", 2, 20, "", 2)).add(("a", 3, 13, "", 4), ("a", 4, 16, "", 8))
    files.add(("a", 5, 14, "", 16)).add(("a", 6, 40, "", 32))
    out = windows.tumble(files.timed("5 seconds"), "ts", "5 seconds", ["user"], F.sum("v").alias("s"))
    assert rows_of(drain(jobs.plain_times(out)), "window_start", "s") == [(at(10), 5), (at(15), 8), (at(20), 2)]


def test_early_results_in_update_mode(spark, files):
    files.add(("a", 1, 1, "", 1)).add(("a", 2, 2, "", 2)).add(("a", 3, 3, "", 4))
    out = windows.tumble(files.timed(), "ts", "1 day", ["user"], F.sum("v").alias("s"), offset="-8 hours")
    query = out.writeStream.format("memory").queryName("early").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r[0] for r in rows_of(spark.table("early"), "s")] == [1, 3, 7]


def test_early_totals_grow_with_every_batch(spark, files):
    files.add(("a", 1, 1, "", 1), ("a", 2, 2, "", 2), ("b", 3, 3, "", 8)).add(("a", 4, 90_000, "", 4))
    files.add(("a", 5, 4, "", 16), ("b", 6, 5, "", None))
    out = drain(jobs.early_totals(files.stream(), "ts", "1 day", ["user"], "v"))
    assert rows_of(out, "user", "window_start", "firing", "total") == [
        ("a", at(0), 1, 3), ("a", at(0), 2, 19), ("a", at(86_400), 1, 4), ("b", at(0), 1, 8), ("b", at(0), 2, 8)]


def test_null_keys_of_streams_do_not_match(spark, files):
    files.add((None, 1, 1, "l", 1), ("a", 2, 2, "l", 2), ("b", 3, 3, "l", 4), (None, 4, 4, "r", 8), ("a", 5, 5, "r", 16))
    end = Closing(spark.createDataFrame([], SCHEMA), "ts")
    def side(name):
        rows_ = end.follow(files.stream().where(kind(name)))
        return jobs.event_time(rows_, "ts").select(F.col("user").alias(f"{name}_user"), F.col("ts").alias(f"{name}_ts"))
    both = joins.match_by_id(side("l"), side("r"), [("l_user", "r_user")], "l_ts", "r_ts", "10 seconds")
    assert rows_of(drain(jobs.plain_times(both), closing=end), "l_user", "r_user", "tag") == [
        ("a", "a", "match"), ("b", None, "left_only"), (None, None, "left_only"), (None, None, "right_only")]


def test_arrival_processors_keep_state_between_batches(files):
    files.add(*[("a", i, i, "", 1 << i) for i in range(4)]).add(*[("a", i, i, "", 1 << i) for i in range(4, 7)])
    counted = jobs.count_windows(files.stream(), ["user"], ["id"], "v", 5, 3)
    assert rows_of(drain(counted)) == [("a", 1, 7), ("a", 2, 62)]
    changes = jobs.changelog(files.stream(), ["user"], ["id"], "v")
    assert rows_of(drain(changes).where("id > 4"), "id", "inserted", "total") == [
        (5, False, 31), (5, True, 63), (6, False, 63), (6, True, 127),
    ]
    joined = jobs.running_reduce(files.stream(), ["user"], ["id"], ["id", "v"], lambda x, y: (x[0], x[1] - y[1]))
    assert rows_of(drain(joined).where("id = 6"), "reduced_id", "reduced_v") == [(0, 1 - 126)]


LOGINS = [("a", 0, "fail"), ("a", 1, "fail"), ("a", 1.5, "ok"), ("a", 2, "fail"), ("a", 3.9, "fail"), ("a", 6, "fail")]


def shuffled_logins(files):
    rows_ = [("a", i, s, k, 0) for i, (_, s, k) in enumerate(LOGINS)]
    # Out of order within the bound of 5 s.
    files.add(rows_[1], rows_[3]).add(rows_[0], rows_[2]).add(rows_[5], rows_[4]).add(("a", 9, 60, "ok", 0))
    return files.timed("5 seconds")


def test_event_order_across_batches(files):
    out = jobs.login_failures(shuffled_logins(files), ["user"], ["id"], kind("fail"), "2 seconds")
    assert rows_of(drain(out)) == [("a", at(0), at(1)), ("a", at(2), at(3.9))]


def test_login_burst(files):
    out = jobs.login_bursts(shuffled_logins(files), ["user"], ["id"], kind("fail"), "2 seconds", 2)
    assert rows_of(drain(out)) == [("a", at(2), at(3.9), 2)]


def test_strict_sequence_stream(files):
    steps = [Step("x", kind("fail")), Step("y", kind("fail"), strict=True)]
    out = jobs.match_sequence(shuffled_logins(files), ["user"], "id", steps, "2 seconds")
    assert rows_of(drain(out), "first_id", "last_id", "tag") == [
        (0, 1, "match"), (1, 1, "timeout"), (3, 4, "match"), (4, 4, "timeout"), (5, 5, "timeout"),
    ]


def test_order_states(spark, files):
    files.add(("paid", 1, 0, "create", 0), ("late", 2, 0, "create", 0), ("never", 3, 0, "create", 0))
    files.add(("paid", 4, 899, "pay", 0), ("orphan", 5, 899, "pay", 0)).add(("late", 6, 900, "pay", 0))
    files.add(("x", 7, 5000, "look", 0)).add(("x", 8, 9000, "look", 0))
    args = (["user"], ["id"], kind("create"), kind("pay"), "15 minutes")
    out = jobs.order_status(files.timed("10 seconds"), *args)
    assert rows_of(drain(out), "user", "tag") == [
        ("late", "late"), ("late", "timeout"), ("never", "timeout"), ("orphan", "no create"), ("paid", "paid"),
    ]
    checked = jobs.order_check(files.timed("10 seconds"), *args)
    assert rows_of(drain(checked), "user", "tag") == [("late", "paid"), ("never", "timeout"), ("paid", "paid")]


def test_rise_and_cap_timers(files):
    files.add(("a", 1, 0, "", 5), ("a", 2, 1, "", 6)).add(("a", 3, 5, "", 6)).add(("a", 4, 86400, "", 7))
    files.add(("a", 5, 86500, "", 8))
    rise = jobs.rise_alert(files.timed(), ["user"], ["id"], "v", "2 seconds")
    assert rows_of(drain(rise)) == [("a", at(1), at(3))]
    cap = jobs.daily_cap(files.timed(), ["user"], ["id"], 1)
    assert rows_of(drain(cap), "id", "tag") == [(1, "pass"), (2, "warn"), (4, "pass"), (5, "warn")]


def test_same_row_twice_is_kept(files):
    files.add(("a", 1, 1, "", 5), ("a", 2, 2, "", 50)).add(("a", 1, 1, "", 5)).add(("a", 9, 60, "", 0))
    out = jobs.daily_cap(files.timed("10 seconds"), ["user"], ["id"], 5)
    assert [r[0] for r in rows_of(drain(out), "id")] == [1, 1, 2]


def test_marker_watermark(files):
    files.add(("a", 1, 1, "mark", 3), ("b", 2, 50, "", 7)).add(("b", 3, 5, "", 2)).add(("b", 4, 11, "mark", 9))
    files.add(("b", 5, 12, "", 1))
    out = jobs.smallest_by_marker(
        files.stream().withColumn("v", F.col("v").cast("double")), "ts", "user", "v", kind("mark"), "10 seconds"
    )
    assert rows_of(drain(out), "user", "window_start", "min_value") == [("a", at(0), 3.0), ("b", at(0), 2.0)]


def test_match_within_stream(spark, files):
    files.add(("k1", 1, 100, "pay", 0), ("k2", 2, 100, "pay", 0), ("k1", 3, 104, "receipt", 0), ("k3", 4, 101, "receipt", 0))
    files.add(("z", 5, 500, "pay", 0), ("z", 6, 500, "receipt", 0))
    files.add(("y", 7, 900, "pay", 0), ("y", 8, 900, "receipt", 0))
    pays = files.timed().where(kind("pay")).select(F.col("user").alias("k"), F.col("id").alias("pay"), F.col("ts").alias("pt"))
    receipts = files.timed().where(kind("receipt")).select(F.col("user").alias("rk"), F.col("id").alias("receipt"), F.col("ts").alias("rt"))
    out = drain(joins.match_within(pays, receipts, [("k", "rk")], "pt", "rt", "5 seconds"))
    assert rows_of(out.where("coalesce(pay, receipt) < 5"), "tag", "pay", "receipt") == [
        ("left_only", 2, None), ("match", 1, 3), ("right_only", None, 4),
    ]


def test_distinct_union_and_routing(files):
    files.add(("a", 1, 1, "x", 40), ("a", 2, 2, "y", 10)).add(("a", 3, 3, "x", 50))
    routed = rows.tag_rows(files.stream(), {"high": F.col("v") > 30}, "low")
    assert rows_of(drain(rows.tagged(routed, "high")), "id") == [(1,), (3,)]
    both = rows.union_distinct(routed.select("user", "kind"), routed.where("v > 30").select("user", "kind"))
    assert rows_of(drain(both)) == [("a", "x"), ("a", "y")]


def test_arrivals_landed_by_a_stream(spark, files):
    """Late rows are kept: land the stream with its arrival marks, then split it."""
    files.add(("a", 1, 10, "", 1)).add(("a", 2, 2, "", 2), ("a", 3, 30, "", 4)).add(("a", 4, 3, "", 8))
    landed = drain(late.with_arrival(files.stream()))
    out = late.split_late(landed, "ts", "arrival_time", "3 seconds", "5 seconds", "3 seconds")
    assert rows_of(out, "id", "lateness") == [(1, "on_time"), (2, "refire"), (3, "on_time"), (4, "dropped")]


# --- restarts ------------------------------------------------------------------------------


def failing_once(spark, files, folder):
    """A running count whose first start breaks on the word ``bug``."""
    broken = {"left": 1}

    def build():
        stop = broken["left"] > 0
        broken["left"] -= 1
        out = jobs.running_reduce(files.stream().withColumn("n", F.lit(1).cast("long")), ["user"], ["id"],
                                  ["n"], lambda x, y: (x[0] + y[0],))
        if stop:
            out = out.withColumn("user", F.when(F.col("id") == 4, F.raise_error(F.lit("bug"))).otherwise(F.col("user")))
        return (
            out.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True)
        )

    return build


@pytest.mark.parametrize("policy", [Restart.fixed(1, 0.1), Restart.rate(1, 300, 0.1)])
def test_restart_gives_unbroken_totals(spark, files, tmp_path, policy):
    for i in range(6):
        files.add(("a", i, i, "", 0))
    run_stream(failing_once(spark, files, tmp_path), policy)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(out, "id", "reduced_n") == [(i, i + 1) for i in range(6)]


def test_no_restart(spark, files, tmp_path):
    for i in range(6):
        files.add(("a", i, i, "", 0))
    with pytest.raises(Exception, match="bug"):
        run_stream(failing_once(spark, files, tmp_path), Restart.never())


def test_own_offsets_resume(spark, tmp_path):
    spark.dataSource.register(OffsetSource)

    def run(available):
        stream = spark.readStream.format("evstream_offsets").option("lanes", 2).option("available", available).load()
        return run_to_table(stream, "offsets", folder=str(tmp_path))

    assert run(3).count() == 6
    assert rows_of(run(5)) == [(lane, n) for lane in range(2) for n in range(5)]


def test_closing_row_ends_windows_and_timers_over_batches(spark, files):
    """Several micro-batches, then the closing row: nothing stays in the state, and the row itself
    is no result."""
    files.add(("a", 1, 1, "create", 1)).add(("a", 2, 9, "pay", 2), ("b", 3, 9, "create", 4)).add(("b", 4, 31, "look", 8))
    like = spark.createDataFrame([], SCHEMA)
    end = Closing(like, "ts")
    timed = jobs.event_time(end.follow(files.stream()), "ts")
    sums = windows.tumble(timed, "ts", "10 seconds", ["user"], F.sum("v").alias("s"))
    assert rows_of(drain(jobs.plain_times(sums), closing=end), "user", "window_start", "s") == [
        ("a", at(0), 3), ("b", at(0), 4), ("b", at(30), 8),
    ]
    end = Closing(like, "ts")
    timed = jobs.event_time(end.follow(files.stream()), "ts")
    status = jobs.order_status(timed, ["user"], ["id"], kind("create"), kind("pay"), "15 minutes")
    assert rows_of(drain(status, closing=end), "user", "tag", "id") == [("a", "paid", 1), ("b", "timeout", 3)]


def _matcher(strict):
    fields = processors.T.StructType().add("_us", "long").add("id", "long").add("a", "boolean").add("b", "boolean")
    fields = fields.add("c", "boolean")
    m = processors.SequenceMatcher(fields, ["_us", "id"], ["a", "b", "c"], [False, False, strict], 10_000_000)
    m.columns = ("key", "first_id", "_a", "last_id", "_b", "matched", "tag")
    return m


@pytest.mark.parametrize("strict", [False, True])
def test_many_open_starts_of_one_key_take_linear_time(strict):
    matcher, out, n = _matcher(strict), [], 100_000
    memory = matcher.load(matcher.initial)

    def put(us, *flags):
        nonlocal memory
        memory = matcher.on_time(("k",), memory, us - 1, out)
        memory = matcher.on_row(("k",), memory, dict(zip(["_us", "id", "a", "b", "c"], [us, us, *flags])), out)

    for us in range(n):
        put(us, True, False, False)
    put(n, False, True, False)
    memory = matcher.load(matcher.save(memory))  # as between two firings
    put(n + 1, False, False, False)
    put(n + 2, False, False, True)
    memory = matcher.on_time(("k",), memory, 1 << 60, out)
    tags = {r.tag for r in out}
    assert len(out) == n and tags == ({"timeout"} if strict else {"match"})
    assert {r.matched for r in out} == ({2} if strict else {3}) and matcher.deadline(memory) is None


def test_many_unpaid_orders_of_one_key_take_linear_time():
    fields = processors.T.StructType().add("_us", "long").add("id", "long").add("c", "boolean").add("p", "boolean")
    check = processors.OrderPayment(fields, ["_us", "id"], "c", "p", 50)
    check.columns = ("key", "_a", "_b", "tag", "id")
    memory, out, n = check.load(check.initial), [], 100_000
    for us in range(n):
        memory = check.on_time(("k",), memory, us - 1, out)
        memory = check.on_row(("k",), memory, {"_us": us, "id": us, "c": True, "p": False}, out)
    memory = check.on_row(("k",), check.load(check.save(memory)), {"_us": n, "id": n, "c": False, "p": True}, out)
    assert sum(r.tag == "timeout" for r in out) == n - 50
    # The create 50 before the pay is late without having timed out first.
    assert sum(r.tag == "late" for r in out) == n - 49 and sum(r.tag == "paid" for r in out) == 49
