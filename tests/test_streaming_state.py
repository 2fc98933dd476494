"""State of streams: windows that fire again, bounded rankings, paged bitmaps, timers, NULL times."""

import random
import sys
from collections import Counter

import pyarrow as pa
import pytest
from conftest import at, rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T
from test_streaming import SCHEMA, drain, files, kind  # noqa: F401  (files is a fixture)

from evstream.operators import alerts, patterns, running
from evstream.operators.patterns import Step
from evstream.streaming import jobs, packs, processors
from evstream.streaming.runner import Closing

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- windows that fire again -----------------------------------------------------------------


def refired(spark, files, job):  # noqa: F811
    end = Closing(spark.createDataFrame([], SCHEMA), "ts")
    return drain(job(end.follow(files.stream())), closing=end)


def test_late_rows_fire_their_window_again(spark, files):  # noqa: F811
    files.add(("a", 1, 1, "", 1), ("b", 2, 2, "", 2)).add(("a", 3, 30, "", 4))  # mark 27: window [0, 5) fires
    files.add(("a", 4, 3, "", 8), ("a", 5, 4, "", 16), ("a", 6, 26, "", 32))  # inside the lateness, twice in one batch
    files.add(("a", 7, 2, "", None)).add(("a", 8, 60, "", 64)).add(("a", 9, 1, "", 128), (None, 10, 59, "", 256))
    out = refired(spark, files, lambda s: jobs.refiring_totals(s, "ts", ["user"], F.col("v"), "3 seconds", "5 seconds", "40 seconds"))
    assert rows_of(out, "user", "window_start", "firing", "total") == [
        ("a", at(0), 1, 1), ("a", at(0), 2, 25), ("a", at(0), 3, 25), ("a", at(25), 1, 32),
        ("a", at(30), 1, 4), ("a", at(60), 1, 64), ("b", at(0), 1, 2), (None, at(55), 1, 256)]


def test_rows_too_late_or_without_a_time_fire_nothing(spark, files):  # noqa: F811
    files.add(("a", 1, 100, "", 1)).add(("a", 2, 3, "", 2), ("a", 3, 92, "", 4))
    stream = lambda s: s.withColumn("ts", F.when(~F.col("id").eqNullSafe(3), F.col("ts")))
    out = refired(spark, files, lambda s: jobs.refiring_totals(stream(s), "ts", ["user"], F.col("v"), "3 seconds", "5 seconds", "6 seconds"))
    assert rows_of(out, "window_start", "firing", "total") == [(at(100), 1, 1)]


def test_a_window_first_reached_by_late_rows_fires_with_them(spark, files):  # noqa: F811
    files.add(("a", 1, 100, "", 1)).add(("b", 2, 91, "", 2)).add(("b", 3, 92, "", 4))
    out = refired(spark, files, lambda s: jobs.refiring_totals(s, "ts", ["user"], F.col("v"), "3 seconds", "5 seconds", "60 seconds"))
    assert rows_of(out.where("user = 'b'"), "firing", "total") == [(1, 2), (2, 6)]


class CountedWindows(processors.RefiringWindow):
    """Leaves a line in a file for every call with rows."""

    def handleInputRows(self, key, rows, timerValues):
        with open(CALLS, "a") as out:
            out.write(f"{key}\n")
        yield from super().handleInputRows(key, rows, timerValues)


def test_calls_of_refiring_windows_follow_windows_and_not_users(spark, files, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sys.modules[__name__], "CALLS", str(tmp_path / "calls"), raising=False)
    monkeypatch.setattr(processors, "RefiringWindow", CountedWindows)
    users = [f"u{i % 400}" for i in range(1000)] + [None] * 5
    files.add(*[(u, i, i % 10, "", i) for i, u in enumerate(users)]).add(*[(u, i, 1, "", 1) for i, u in enumerate(users[:500])])
    out = refired(spark, files, lambda s: jobs.refiring_totals(s, "ts", ["user"], F.col("v"), "0 seconds", "5 seconds", "60 seconds"))
    want = Counter()
    for i, u in enumerate(users):
        want[u, i % 10 // 5] += i
    told = {(r.user, r.window_start.second // 5, r.firing): r.total for r in out.collect()}
    assert {k: told[*k, 1] for k in want} == want
    assert {u: v for (u, w, n), v in told.items() if n == 2} == {u: want[u, 0] + (2 if int(u[1:]) < 100 else 1) for u in users[:400] if (u, 0) in want}
    assert len(told) == 401 + 200 + 200  # in time, corrected, reached by late rows alone
    assert len(open(CALLS).readlines()) <= 3 * 8  # three windows and micro-batches in eight shares each


def test_sums_of_packs():
    t = pa.table({"k": ["a", "a", None, "b"], "_v": pa.array([1, 2, 3, None], pa.int64())})
    assert packs.sums(t, ["k"], "_v").to_pydict() == {"k": ["a", None, "b"], "_v": [3, 3, None]}
    with pytest.raises(pa.ArrowInvalid):
        packs.sums(pa.table({"k": [1, 1], "_v": [1 << 62, 1 << 62]}), ["k"], "_v")


@pytest.mark.parametrize("lanes", [3])
def test_rankings_are_made_anew(spark, files, lanes):  # noqa: F811
    files.add(*[(u, i, 1, "", v) for i, (u, v) in enumerate([("a", 5), ("b", 5), ("c", 3), ("d", 1)])]).add(("z", 9, 30, "", 1))
    files.add(("d", 10, 2, "", 9)).add(("c", 11, 2, "", 2), ("e", 12, 2, "", 5))
    out = refired(spark, files, lambda s: jobs.refiring_top(
        s, "ts", "user", "3 seconds", "5 seconds", "60 seconds", 2, F.col("v"), lanes))
    got = rows_of(out.where(F.col("window_end") == F.lit(at(5))), "firing", "rank", "user", "cnt")
    assert got == [(1, 1, "a", 5), (1, 2, "b", 5), (2, 1, "d", 10), (2, 2, "a", 5), (3, 1, "d", 10), (3, 2, "a", 5)]


class CountedRanks(processors.BestOfWindow):
    """Leaves a line in a file for every row that is ranked."""

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        with open(CALLS, "a") as out:
            out.write(f"{key}\n" * len(rows))
        yield from super().handleInputRows(key, iter(rows), timerValues)


def test_rows_that_are_ranked_follow_n_and_not_users(spark, files, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sys.modules[__name__], "CALLS", str(tmp_path / "calls"), raising=False)
    monkeypatch.setattr(processors, "BestOfWindow", CountedRanks)
    r = random.Random(7)
    counts = {f"u{i}": r.randint(0, 50) for i in range(500)}
    files.add(*[(u, i, 1, "", v) for i, (u, v) in enumerate(counts.items())], (None, 998, 1, "", 99), ("z", 999, 30, "", 1))
    files.add(*[(f"u{i}", i, 2, "", 40) for i in range(300)], ("z", 999, 31, "", 1))
    out = refired(spark, files, lambda s: jobs.refiring_top(
        s, "ts", "user", "3 seconds", "5 seconds", "60 seconds", 2, F.col("v"), 3))
    again = {u: v + (40 if int(u[1:]) < 300 else 0) for u, v in counts.items()}
    want = [(n, i, u, c[u]) for n, c in ((1, counts), (2, again)) for i, u in enumerate(sorted(c, key=lambda u: (-c[u], u))[:2], 1)]
    assert rows_of(out.where(F.col("window_end") == F.lit(at(5))), "firing", "rank", "user", "cnt") == want
    assert len(open(CALLS).readlines()) < 100


class Held(list):
    """Stands in for list and value state."""

    def get(self):
        return list(self)

    def put(self, rows):
        self[:] = rows


def test_ranking_state_follows_n_whatever_the_number_of_items():
    r = random.Random(4)
    best = processors.BestOfWindow(5, "item", "cnt", T.StructType())
    best.best, totals, most = Held(), Counter(), 0
    for _ in range(60):
        changed = {}
        for _ in range(200):
            item = r.randint(0, 3000)
            totals[item] += r.randint(0, 3)
            changed[item] = totals[item]
        best.best.put(best._merged({"item": k, "cnt": v} for k, v in changed.items())[1])
        most = max(most, len(best.best))
        assert best.best == sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert most == 5
    assert best._merged([{"item": None, "cnt": 99_999}]) == (list(best.best), list(best.best), set())


# --- the paged bitmap ------------------------------------------------------------------------


@pytest.mark.parametrize("page_bits,slices", [(1 << 24, 16), (1 << 29, 1)])
def test_bitmap_pages_and_slices_give_the_table_form(spark, files, page_bits, slices):  # noqa: F811
    r = random.Random(page_bits)
    rows = [(f"u{r.randint(0, 30)}" if r.random() < 0.9 else None, i, r.choice([r.randint(0, 119), 60]), "", 0) for i in range(150)]
    for k in range(0, 150, 50):
        files.add(*rows[k:k + 50])
    end = Closing(spark.createDataFrame([], SCHEMA), "ts")
    timed = jobs.event_time(end.follow(files.stream()), "ts", "200 seconds")
    out = drain(jobs.running_distinct_bitmap(timed, "ts", "60 seconds", "user", ["id"], page_bits=page_bits, slices=slices), closing=end)
    table = spark.createDataFrame([(u, i, at(s), k, v) for u, i, s, k, v in rows], SCHEMA)
    want = running.bitmap_distinct_running(table, "ts", "60 seconds", "user", ["ts", "id"])
    assert rows_of(out, "id", "window_end", "uv") == rows_of(want, "id", "window_end", "uv")


def test_a_window_of_the_bitmap_is_handled_by_many_keys(spark):
    """One hour of views: what the stages are dealt by has more than eight values."""
    from evstream.functions.hashing import bitmap_offset

    users = spark.range(500).select(F.col("id").cast("string").alias("u"))
    pages = users.select((bitmap_offset("u") / jobs.PAGE_BITS).cast("int").alias("p")).distinct().count()
    assert jobs.SLICES >= 8 and (1 << 29) // jobs.PAGE_BITS == 512 and pages >= 1


# --- timers ----------------------------------------------------------------------------------


class CountedOrders(processors.OrderPayment):
    """Tells every firing of a timer as well."""

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.row(*key, None, expiredTimerInfo.getExpiryTimeInMs() * 1000, "timer", None)
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


def test_no_timer_of_a_resolved_order_fires(spark, files, monkeypatch):  # noqa: F811
    monkeypatch.setattr(processors, "OrderPayment", CountedOrders)
    files.add(("paid", 1, 0, "create", 0), ("open", 2, 0, "create", 0), ("two", 3, 0, "create", 0)).add(("x", 4, 50, "look", 0))
    files.add(("x", 5, 60, "look", 0)).add(("paid", 6, 100, "pay", 0), ("two", 7, 300, "create", 0)).add(("x", 8, 400, "look", 0))
    files.add(("two", 9, 500, "pay", 0)).add(("x", 10, 5000, "look", 0)).add(("x", 11, 9000, "look", 0))
    timed = files.timed("0 seconds").where(kind("create") | kind("pay") | (F.col("user") == "x"))
    out = drain(jobs.order_status(timed, ["user"], ["id"], kind("create"), kind("pay"), "15 minutes"))
    assert rows_of(out.where("tag <> 'timer'"), "user", "tag") == [
        ("open", "timeout"), ("paid", "paid"), ("two", "paid"), ("two", "paid")]
    # Creates were handled at 50 s and stood open until their pay: only what was never paid times out.
    fired = rows_of(out.where(F.col("tag") == "timer").where("user <> 'x'"), "user", "pay_time")
    assert [f for f in fired if f[1] >= at(900)] == [("open", at(900))] and len(fired) <= 8


# --- rows without an event time ---------------------------------------------------------------


def with_gaps(spark, files, bound="0 seconds"):  # noqa: F811
    """A table and a stream of the same rows, some of them without a time."""
    r = random.Random(8)
    rows = [(f"u{r.randint(0, 3)}", i, 3 * i + r.randint(0, 1), r.choice(["create", "pay", "fail", "ok"]), r.randint(0, 30)) for i in range(120)]
    for k in range(0, 120, 30):  # four micro-batches
        files.add(*rows[k:k + 30])
    table = spark.createDataFrame([(u, i, at(s), k, v) for u, i, s, k, v in rows], SCHEMA)
    gaps = lambda df: df.withColumn("ts", F.when(F.col("id") % 7 != 3, F.col("ts")))
    end = Closing(table, "ts")
    return gaps(table), jobs.event_time(end.follow(gaps(files.stream())), "ts", bound), end


def test_jump_alert_without_times(spark, files):  # noqa: F811
    table, stream, end = with_gaps(spark, files)
    got = drain(jobs.jump_alert(stream, ["user"], ["id"], "v", 8.0), closing=end)
    assert rows_of(got, "id", "user") == rows_of(alerts.jump_alert(table, ["user"], ["ts", "id"], "v", 8.0), "id", "user") != []


def test_rise_cap_and_failures_without_times(spark, files):  # noqa: F811
    table, stream, end = with_gaps(spark, files)
    got = drain(jobs.rise_alert(stream, ["user"], ["id"], "v", "20 seconds"), closing=end)
    assert rows_of(got) == rows_of(alerts.rise_alert(table, ["user"], ["ts", "id"], "v", "20 seconds"))
    _, stream, end = with_gaps(spark, files)
    got = drain(jobs.daily_cap(stream.dropDuplicates(["id", "ts"]), ["user"], ["id"], 5), closing=end)
    assert rows_of(got, "id", "tag") == rows_of(alerts.daily_cap(table, ["user"], ["ts", "id"], 5), "id", "tag")


def test_orders_without_times(spark, files):  # noqa: F811
    table, stream, end = with_gaps(spark, files)
    args = (kind("create"), kind("pay"), "30 seconds")
    got = drain(jobs.order_status(stream, ["user"], ["id"], *args), closing=end)
    last = got.groupBy("user", "id").agg(F.max(F.struct("pay_time", "create_time", "tag")).alias("s")).select("user", "s.create_time", "s.pay_time", "s.tag")
    assert rows_of(last) == rows_of(alerts.order_status(table, ["user"], ["ts", "id"], *args)) != []


def test_sequences_without_times(spark, files):  # noqa: F811
    table, stream, end = with_gaps(spark, files)
    steps = [Step("a", kind("create")), Step("b", kind("fail")), Step("c", kind("pay"), strict=True)]
    got = drain(jobs.match_sequence(stream, ["user"], "id", steps, "60 seconds"), closing=end)
    want = patterns.match_sequence(table, ["user"], ["ts", "id"], steps, "60 seconds").select(F.col("a.id").alias("first_id"), "matched", "tag")
    assert rows_of(got, "first_id", "matched", "tag") == rows_of(want) != []


def test_marked_minimum_without_times(spark, files):  # noqa: F811
    table, _, _ = with_gaps(spark, files)
    gaps = files.stream().withColumn("ts", F.when(F.col("id") % 7 != 3, F.col("ts"))).withColumn("v", F.col("v").cast("double"))
    end = Closing(table.withColumn("v", F.col("v").cast("double")), "ts")
    got = drain(jobs.smallest_by_marker(end.follow(gaps), "ts", "user", "v", kind("pay"), "30 seconds", "60 seconds"), closing=end)
    want = table.where("ts is not null").groupBy("user", F.window("ts", "30 seconds").alias("w")).agg(F.min("v").cast("double").alias("m"))
    assert rows_of(got, "user", "window_start", "min_value") == rows_of(want.select("user", F.col("w.start").cast("timestamp_ntz").alias("s"), "m"))


class CountedMinima(processors.MarkedWindow):
    """Leaves a line in a file for every row that reaches a window."""

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        with open(CALLS, "a") as out:
            out.write(f"{key}\n" * len(rows))
        yield from super().handleInputRows(key, iter(rows), timerValues)


def test_rows_of_a_marked_window_are_cut_in_their_tasks(spark, files, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sys.modules[__name__], "CALLS", str(tmp_path / "calls"), raising=False)
    monkeypatch.setattr(processors, "MarkedWindow", CountedMinima)
    r = random.Random(11)
    data = [(r.choice(["a", "b", None]), i, r.randint(0, 29), "pay" if i % 5 == 0 else "look", r.choice([None, *range(3, 900)])) for i in range(900)]
    files.add(*data[:600]).add(*data[600:], ("n", 900, 5, "look", None))
    table = spark.createDataFrame([(u, i, at(s), k, v) for u, i, s, k, v in [*data, ("n", 900, 5, "look", None)]], SCHEMA)
    end = Closing(table.withColumn("v", F.col("v").cast("double")), "ts")
    rows = end.follow(files.stream().withColumn("v", F.col("v").cast("double")))
    got = drain(jobs.smallest_by_marker(rows, "ts", "user", "v", kind("pay"), "10 seconds", "60 seconds"), closing=end)
    want = table.groupBy("user", F.window("ts", "10 seconds").alias("w")).agg(F.min("v").cast("double").alias("m"))
    assert rows_of(got, "user", "window_start", "min_value") == rows_of(want.select("user", F.col("w.start").cast("timestamp_ntz").alias("s"), "m"))
    assert len(open(CALLS).readlines()) < 300


def test_a_late_marker_row_of_an_open_window_stays_out(spark, files):  # noqa: F811
    """As before the rows were cut: the larger row that is no marker, or a later marker, is the minimum."""
    files.add(("a", 1, 17, "pay", 50)).add(("a", 2, 18, "pay", 40)).add(("a", 3, 18, "pay", 30))
    files.add(("a", 4, 11, "pay", 1), ("a", 5, 12, "look", 20), ("a", 6, 13, "look", 25), ("a", 7, 19, "pay", 22))
    files.add(("a", 8, 12, "pay", 2), ("a", 9, 31, "pay", 9)).add(("a", 10, 32, "pay", 8))
    rows = files.stream().withColumn("v", F.col("v").cast("double"))
    got = drain(jobs.smallest_by_marker(rows, "ts", "user", "v", kind("pay"), "10 seconds", "0 seconds"))
    assert rows_of(got, "window_start", "min_value") == [(at(10), 20.0)]


def test_least_of_marked_rows_whatever_the_watermark():
    r = random.Random(1)
    values = [None, float("nan"), float("inf"), 0.0, 1.0, 2.0, -1.0]

    def least(rows, mark):
        out = {}
        for key, start, m, v in rows:
            if m is None or m > mark:
                out.setdefault((key, start), []).append(v)
        return {k: min(vs, key=lambda v: (v is None, v != v, v or 0)) for k, vs in out.items()}

    for _ in range(60):
        rows = [(r.choice(["a", None]), r.choice([0, 10]), r.choice([None, *range(9)]), r.choice(values)) for _ in range(r.randint(1, 30))]
        kinds = zip(["_key", "_start", "_mark", "_v"], zip(*rows), [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.float64()])
        left = jobs._smallest(pa.table({name: pa.array(column, kind_) for name, column, kind_ in kinds}))
        left = left.set_column(2, "_mark", left["_mark"].cast(pa.int64()))
        kept = list(zip(*(left[c].to_pylist() for c in left.column_names)))
        assert all(str(least(rows, mark)) == str({k: least(kept, mark)[k] for k in least(rows, mark)}) for mark in range(-1, 10))
        assert least(kept, -1).keys() == least(rows, -1).keys()


# --- hot keys --------------------------------------------------------------------------------


@pytest.mark.parametrize("fold,function", [("sum", F.sum), ("max", F.max)])
def test_running_folds_of_a_hot_key_in_slices(spark, files, fold, function):  # noqa: F811
    from pyspark.sql import Window

    r = random.Random(12)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, i, "", r.choice([None, 1, 2, 5, -3])) for i in range(400)]
    for k in range(0, 400, 100):
        files.add(*r.sample(rows[k:k + 100], 100))
    cut = F.call_function("div", F.col("id"), F.lit(30))
    out = drain(jobs.running_fold(files.stream(), ["user"], ["id"], "v", cut, fold))
    table = spark.createDataFrame([(u, i, v) for u, i, _, _, v in rows], "user string, id bigint, v bigint")
    want = table.withColumn("total", function("v").over(Window.partitionBy("user").orderBy("id")))
    assert rows_of(out, "user", "id", "total") == rows_of(want, "user", "id", "total")


def test_slices_of_a_key_are_folded_apart():
    carry = processors.SliceCarry("v", lambda a, b: a + b)
    carry.columns, carry.held = ("k", "slice", "start"), _Value()
    first = [tuple(x) for x in carry.handleInputRows(("k",), [{"_slice": s, "v": v} for s, v in [(2, 5), (0, 1), (0, 2), (1, None)]], None)]
    again = [tuple(x) for x in carry.handleInputRows(("k",), [{"_slice": 3, "v": 7}], None)]
    assert first == [("k", 0, None), ("k", 1, 3), ("k", 2, 3)] and again == [("k", 3, 8)]


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


# --- sequences -------------------------------------------------------------------------------


class CountingMap(processors.Kept):
    writes = 0

    def updateValue(self, key, value):
        CountingMap.writes += 1
        super().updateValue(key, value)

    def removeKey(self, key):
        CountingMap.writes += 1
        super().removeKey(key)


def sequence_matcher(strict=(False, False, False), within=10_000_000):
    fields = T.StructType().add("_us", "long").add("id", "long").add("a", "boolean").add("b", "boolean").add("c", "boolean")
    m = processors.SequenceMatcher(fields, ["_us", "id"], ["a", "b", "c"], list(strict), within)
    m.columns = ("key", "first_id", "_a", "last_id", "_b", "matched", "tag")
    return m


def test_a_row_writes_as_much_state_whatever_the_number_of_open_starts():
    m = sequence_matcher()
    m.starts, m.stretches = CountingMap(), CountingMap()
    held, out, written = m.initial, [], []
    for us in range(100_000):
        memory = m.load(held) if us % 1000 == 0 else memory  # a firing for every thousand rows
        memory = m.on_row(("k",), memory, {"_us": us, "id": us, "a": True, "b": False, "c": False}, out)
        if us % 1000 == 999:
            before = CountingMap.writes
            held = m.save(memory)
            written.append(CountingMap.writes - before)
    assert max(written) == 1 and len(m.starts) == 100_000 and len(m.stretches) == 1
    for us, step in ((100_000, "b"), (100_001, "x"), (100_002, "a"), (100_003, "b")):
        before, memory = CountingMap.writes, m.load(held)
        memory = m.on_row(("k",), memory, {"_us": us, "id": us, **{f: f == step for f in "abc"}}, out)
        held = m.save(memory)
        assert CountingMap.writes - before <= 2 and not out
    memory = m.on_row(("k",), m.load(held), {"_us": 100_004, "id": 100_004, "a": False, "b": False, "c": True}, out)
    assert len(out) == 100_001 and {r.tag for r in out} == {"match"} and m.save(memory) == (0, 100_001)
    assert not m.starts and not m.stretches


@pytest.mark.parametrize("strict", [(False, False, False), (False, True, False), (False, False, True), (False, True, True)])
def test_sequences_equal_a_search(strict):
    """Every start by itself, over random rows that fit several steps at once or none."""
    r = random.Random(str(strict))
    for trial in range(60):
        within = r.choice([3, 8, 50])
        m, out, us, rows = sequence_matcher(strict, within), [], 0, []
        for i in range(r.randint(1, 40)):
            us += r.randint(0, 2)
            rows.append({"_us": us, "id": i, **{f: r.random() < 0.35 for f in "abc"}})
        held = m.initial
        for row in rows:
            memory = m.load(held)  # a firing for every row
            memory = m.on_time(("k",), memory, row["_us"] - 1, out)
            held = m.save(m.on_row(("k",), memory, row, out))
        memory = m.on_time(("k",), m.load(held), 1 << 60, out)
        assert m.deadline(memory) is None and (m.save(memory) or True) and not m.starts and not m.stretches
        want = []
        for i, start in enumerate(rows):
            if start["a"]:
                events, at, dead = [start], i, False
                for step in (1, 2):
                    later = rows[at + 1:at + 2] if strict[step] else rows[at + 1:]
                    at = next((rows.index(x) for x in later if x["abc"[step]] and x["_us"] - start["_us"] < within), None)
                    if at is None:
                        break
                    events.append(rows[at])
                want.append((start["id"], events[-1]["id"], len(events), "match" if len(events) == 3 else "timeout"))
        assert sorted((x.first_id, x.last_id, x.matched, x.tag) for x in out) == sorted(want), trial


class CountedChanges(processors.Changelog):
    """Leaves the key of every call with rows in a file."""

    def handleInputRows(self, key, rows, timerValues):
        with open(CALLS, "a") as out:
            out.write(f"{key}\n")
        yield from super().handleInputRows(key, rows, timerValues)


@pytest.mark.parametrize("having", [None, lambda total: total % 3 == 0])
def test_change_log_of_a_hot_key_in_slices(spark, files, tmp_path, monkeypatch, having):  # noqa: F811
    monkeypatch.setattr(sys.modules[__name__], "CALLS", str(tmp_path / "calls"), raising=False)
    monkeypatch.setattr(processors, "Changelog", CountedChanges)
    r = random.Random(5)
    rows = [(r.choice(["hot", "hot", "hot", "few", None, "none"]), i, 0, "", r.choice([None, 0, 0, *range(-4, 9)])) for i in range(400)]
    rows = [(u, i, s, k, None if u == "none" or i < 20 else v) for u, i, s, k, v in rows]
    first, second = rows[:250], rows[250:]
    r.shuffle(first)
    files.add(*first).add(*second)
    got = drain(jobs.changelog(files.stream(), ["user"], ["id"], "v", "sum", having, F.call_function("div", F.col("id"), F.lit(40))))
    table = spark.createDataFrame([(u, i, at(s), k, v) for u, i, s, k, v in rows], SCHEMA)
    want = running.changelog(table.withColumn("user", F.coalesce("user", F.lit("?"))), ["user"], ["id"], "v", "sum", **({"having": lambda c: c % 3 == 0} if having else {}))
    columns = ["id", "inserted", "sum"]
    assert rows_of(got.withColumn("user", F.coalesce("user", F.lit("?"))), "user", *columns) == rows_of(want, "user", *columns) != []
    assert len({line for line in open(CALLS) if "hot" in line}) == 10  # slices of 40 ids


def test_change_log_query_deals_a_word_to_many_calls(spark, sql, tmp_path, monkeypatch):
    import compare
    from evstream.plans import stream_queries
    from evstream.plans.queries import ORACLE, QUERIES
    from test_queries import DATA

    monkeypatch.setattr(sys.modules[__name__], "CALLS", str(tmp_path / "calls"), raising=False)
    monkeypatch.setattr(processors, "Changelog", CountedChanges)
    monkeypatch.setattr(stream_queries, "SLICE_BYTES", 2048, raising=False)
    assert compare.differences(sql, QUERIES["stream_changelog_sum"](spark, DATA), ORACLE["stream_changelog_sum"]) == ""
    assert len(open(CALLS).readlines()) >= 20  # five words
