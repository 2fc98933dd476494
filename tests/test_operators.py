"""Operators on literal rows: edges, ties, empty input."""

import sys

import pytest
from conftest import at, rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from evstream import schemas
from evstream.functions.hashing import bitmap_offset
from evstream.operators import alerts, joins, late, partition, patterns, rows, running, windows
from evstream.operators.common import broadcast_if_small, fixed_width
from evstream.operators.patterns import Step
from evstream.operators.timeline import nearest, running_count, running_max, running_sum, timeline

KEYED = "user string, id bigint, ts timestamp_ntz, kind string, v bigint"
ORDER = ["ts", "id"]


def events(spark, *data):
    """Rows (user, seconds, kind, value); the id follows the given order."""
    return spark.createDataFrame(
        [(u, i, at(s), k, v) for i, (u, s, k, v) in enumerate(data)], KEYED
    )


def kind(name):
    return F.col("kind") == name


# --- golden rows ---------------------------------------------------------------------------


def test_changelog_golden(spark):
    words = spark.createDataFrame([(0, "Hello", 1), (1, "sord", 1), (2, "Hello", 1)], "id int, word string, f int")
    out = running.changelog(words, ["word"], ["id"], "f", "frequency")
    assert rows_of(out, "id", "inserted", "word", "frequency") == [
        (0, True, "Hello", 1), (1, True, "sord", 1), (2, False, "Hello", 1), (2, True, "Hello", 2),
    ]


def test_changelog_having_enters_and_leaves(spark):
    words = spark.createDataFrame([(i, "w", 1) for i in range(3)], "id int, word string, f int")
    out = running.changelog(words, ["word"], ["id"], "f", having=lambda c: c == 2)
    assert rows_of(out, "id", "inserted", "total") == [(1, True, 2), (2, False, 2)]


def test_city_running_max_golden(spark):
    data = [("Beijing", 1), ("Shanghai", 2), ("Beijing", 6), ("Shanghai", 8), ("Beijing", 3), ("Shanghai", 4)]
    cities = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, city string, v bigint")
    out = running.running(cities, ["city"], ["i"], top=running_max("v"))
    assert [r[1] for r in rows_of(out, "i", "top")] == [1, 2, 6, 8, 6, 8]


def test_running_max_by_keeps_first_of_equals(spark):
    df = events(spark, ("a", 1, "x", 5), ("a", 2, "y", 5), ("a", 3, "z", 6))
    out = running.running_max_by(df, ["user"], ORDER, "v", ["kind"])
    assert [r[1] for r in rows_of(out, "id", "max_kind")] == ["x", "x", "z"]


def test_table_orders_distinct_union_golden(spark):
    a = spark.createDataFrame([(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schemas.TABLE_ORDER)
    b = spark.createDataFrame([(2, "pen", 3), (2, "diaper", 3), (4, "rubber", 1)], schemas.TABLE_ORDER)
    out = rows.union_distinct(a.where("amount > 2"), b.where("amount > 1"))
    assert rows_of(out) == [(1, "beer", 3), (1, "diaper", 4), (2, "diaper", 3), (2, "pen", 3)]


def test_split_and_union_golden(spark):
    sensors = spark.createDataFrame(
        [("sensor_1", 35.8), ("sensor_6", 15.4), ("sensor_7", 6.7), ("sensor_10", 38.1)], "id string, t double"
    )
    routed = rows.tag_rows(sensors, {"high": F.col("t") > 30}, "low")
    high, low, both = (rows.tagged(routed, *n) for n in (["high"], ["low"], ["high", "low"]))
    assert [r[0] for r in rows_of(high, "id")] == ["sensor_1", "sensor_10"]
    assert rows.union_all(high, low, both).count() == 8


def test_field_reduce(spark):
    df = events(spark, ("a", 1, "p", 10), ("a", 2, "q", 20), ("a", 3, "r", 30), ("b", 1, "s", 7))
    out = running.running_field_reduce(df.withColumn("w", F.col("v") * 1.0), ["user"], ORDER, "kind", ("v", 1), ("w", 10.0))
    assert [r[1:] for r in rows_of(out, "id", "reduced_kind", "reduced_v", "reduced_w")] == [
        ("p", 10, 10.0), ("p", 11, 30.0), ("p", 12, 40.0), ("s", 7, 7.0),
    ]


# --- parsing and words ---------------------------------------------------------------------


def test_parse_trims_and_ignores_surplus(spark):
    lines = spark.createDataFrame([(" s1 , 7, 1.5 ,extra",)], "value string")
    assert rows_of(rows.parse_delimited(lines, schemas.SENSOR)) == [("s1", 7, 1.5)]


@pytest.mark.parametrize("line", ["s1, x, 1.5", "s1, 7"])
def test_parse_bad_line(spark, line):
    lines = spark.createDataFrame([("s0,1,2",), (line,)], "value string")
    with pytest.raises(Exception):
        rows.parse_delimited(lines, schemas.SENSOR).collect()
    assert rows_of(rows.parse_delimited(lines, schemas.SENSOR, on_error="drop")) == [("s0", 1, 2.0)]
    kept = rows.parse_delimited(lines, schemas.SENSOR, on_error="quarantine")
    assert [r[0] for r in rows_of(kept.where("_bad is not null"), "_bad")] == [line]


def test_words(spark):
    text = spark.createDataFrame([("a  b  \n\n   \n B-a É\r\n",)], "t string")
    space = [r[0] for r in rows_of(rows.tokens(text, "t", "space"))]
    # 'a','','b' | '' | nothing | '','B-a','É'
    assert space == sorted(["a", "", "b", "", "", "B-a", "É"])
    assert [r[0] for r in rows_of(rows.tokens(text, "t", "whitespace"))] == sorted(["a", "b", "B-a", "É"])
    assert [r[0] for r in rows_of(rows.tokens(text, "t", "lowered"))] == ["a", "a", "b", "b"]
    assert rows.tokens(spark.createDataFrame([("",)], "t string"), "t", "space").count() == 0


def test_access_log(spark):
    line = "83.149.9.216 17 - 17/05/2015:10:05:03 +0000 GET /a/b.png"
    out = rows.parse_access_log(spark.createDataFrame([(line,)], "value string"))
    assert rows_of(out) == [("83.149.9.216", "17", at(10 * 3600 + 303, "2015-05-17"), "GET", "/a/b.png")]


def test_bitmap_offset_wraps_like_unmasked_sum(spark):
    ids = ["1", "543462", "123456789012345", ""]
    out = spark.createDataFrame([(i,) for i in ids], "u string").select("u", bitmap_offset("u").alias("b"))

    def plain(s):
        h = 0
        for c in s:
            h = h * 61 + ord(c)
        return h & ((1 << 29) - 1)

    assert dict(rows_of(out)) == {i: plain(i) for i in ids}


# --- windows -------------------------------------------------------------------------------


def test_window_bounds(spark):
    df = events(spark, ("a", 0, "", 1), ("a", 9.999999, "", 2), ("a", 10, "", 4))
    out = windows.tumble(df, "ts", "10 seconds", ["user"], F.sum("v").alias("s"))
    assert rows_of(out, "window_start", "s") == [(at(0), 3), (at(10), 4)]


def test_offset_window(spark):
    df = events(spark, ("a", 16 * 3600, "", 1), ("a", 16 * 3600 - 1, "", 2))
    out = windows.tumble(df, "ts", "1 day", [], F.sum("v").alias("s"), offset="-8 hours")
    assert rows_of(out, "window_start", "s") == [(at(-8 * 3600), 2), (at(16 * 3600), 1)]


@pytest.mark.parametrize("extremes", [False, True])
def test_slide_equals_plain_windows(spark, extremes):
    data = [(u, s, "", s) for u in "ab" for s in (0, 1, 4, 5, 11, 12, 12, 40, 41)]
    df = events(spark, *data)
    asked = {"top": ("max", F.col("v"))} if extremes else None
    ours = windows.slide(df, "ts", "10 seconds", "5 seconds", ["user"], sums={"s": F.col("v")}, extremes=asked)
    plain = windows.slide_stream(
        df, "ts", "10 seconds", "5 seconds", ["user"], F.count(F.lit(1)).alias("cnt"), F.sum("v").alias("s"),
        F.max("v").alias("top"),
    )
    cols = ["user", "window_start", "window_end", "cnt", "s"] + (["top"] if extremes else [])
    assert rows_of(ours, *cols) == rows_of(plain, *cols)


def test_slide_empty(spark):
    assert windows.slide(events(spark).limit(0), "ts", "10 seconds", "5 seconds", ["user"]).count() == 0


def test_session_gap(spark):
    df = events(spark, ("a", 0, "", 1), ("a", 10, "", 2), ("a", 20.001, "", 4), ("a", 30, "", 8),
                ("b", 0, "", 1), ("b", 9.999, "", 2), ("b", 19.9991, "", 4))
    out = windows.sessions(df, "ts", "10 seconds", ["user"], sums={"s": F.col("v")})
    assert rows_of(out, "user", "session_start", "session_end", "cnt", "s") == [
        ("a", at(0), at(20), 2, 3), ("a", at(20.001), at(40), 2, 12), ("b", at(0), at(19.999), 2, 3),
        ("b", at(19.9991), at(29.9991), 1, 4),
    ]
    plain = windows.session_stream(df, "ts", "10 seconds", ["user"], F.count(F.lit(1)).alias("cnt"))
    assert rows_of(out, "user", "session_start", "cnt") == rows_of(plain, "user", "session_start", "cnt")


def test_count_windows(spark):
    data = [(u, s, "", 1 << s) for u, n in (("four", 4), ("five", 5), ("six", 6), ("many", 15)) for s in range(n)]
    df = events(spark, *data)
    tumbled = rows_of(windows.count_tumble(df, ["user"], ORDER, 5, s=F.col("v")), "user", "firing", "s")
    assert tumbled == [("five", 1, 31), ("many", 1, 31), ("many", 2, 31 << 5), ("many", 3, 31 << 10), ("six", 1, 31)]
    slid = rows_of(windows.count_slide(df, ["user"], ORDER, 5, 3, s=F.col("v")), "user", "firing", "s")
    assert [r for r in slid if r[0] == "four"] == [("four", 1, 7)]
    assert [r[2] for r in slid if r[0] == "many"] == [7, 62, 31 << 4, 31 << 7, 31 << 10]


def test_top_n_ties_and_short_groups(spark):
    df = spark.createDataFrame([("w", "b", 2), ("w", "a", 2), ("w", "c", 2), ("x", "z", 1)], "w string, item string, cnt int")
    out = windows.top_n(df, ["w"], [F.desc("cnt"), F.asc("item")], 2)
    assert rows_of(out, "w", "rank", "item") == [("w", 1, "a"), ("w", 2, "b"), ("x", 1, "z")]


def test_members_in_pages(spark):
    df = events(spark, *[("a", s, "", 0) for s in (3, 1, 2)])
    out = windows.window_members(df, "ts", "10 seconds", ["user"], "id", page=2)
    assert rows_of(out, "page", "cnt", "members") == [(0, 2, "00:00:01,00:00:02"), (1, 1, "00:00:03")]


def test_approximate_distinct(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("u"), F.lit(at(1)).alias("ts"))
    assert abs(windows.approx_distinct_per_window(df, "ts", "1 hour", "u").first()["uv"] - 5000) < 400


# --- joins ---------------------------------------------------------------------------------


def pay_and_receipt(spark):
    pays = spark.createDataFrame([("k", 1, at(100)), ("k", 2, at(500)), (None, 3, at(100))], "k string, pay int, pt timestamp_ntz")
    times = [95, 105, 94.999, 105.001, 700]
    receipts = spark.createDataFrame(
        [("k", i, at(t)) for i, t in enumerate(times)] + [(None, 9, at(100))], "rk string, receipt int, rt timestamp_ntz"
    )
    return pays, receipts


def test_interval_join_bounds(spark):
    pays, receipts = pay_and_receipt(spark)
    out = joins.interval_join(pays, receipts, [("k", "rk")], "pt", "rt", "-5 seconds", "5 seconds")
    assert rows_of(out, "pay", "receipt") == [(1, 0), (1, 1)]
    assert out.columns == ["k", "pay", "pt", "rk", "receipt", "rt"]


def test_match_within(spark):
    pays, receipts = pay_and_receipt(spark)
    out = joins.match_within(pays, receipts, [("k", "rk")], "pt", "rt", "5 seconds")
    assert rows_of(out, "tag", "pay", "receipt") == sorted(
        [("match", 1, 0), ("match", 1, 1), ("left_only", 2, None), ("left_only", 3, None)]
        + [("right_only", None, r) for r in (2, 3, 4, 9)],
        key=lambda r: tuple((v is None, str(type(v)), v) for v in r),
    )


# --- sequences, alerts, orders -------------------------------------------------------------

LOGINS = [
    ("a", 0, "fail", 0), ("a", 1, "fail", 0), ("a", 3, "fail", 0),
    ("b", 0, "fail", 0), ("b", 0.5, "ok", 0), ("b", 1, "fail", 0),
    ("c", 0, "fail", 0), ("c", 0, "fail", 0), ("c", 1.999999, "fail", 0),
]
PAIRS = [("a", at(0), at(1)), ("c", at(0), at(0)), ("c", at(0), at(1.999999))]


def test_repeated_failure(spark):
    out = alerts.repeated_failure(events(spark, *LOGINS), ["user"], ORDER, kind("fail"), "2 seconds")
    assert rows_of(out) == PAIRS


def test_strict_sequence_agrees(spark, sliced):
    steps = [Step("x", kind("fail")), Step("y", kind("fail"), strict=True)]
    out = patterns.match_sequence(events(spark, *LOGINS), ["user"], ORDER, steps, "2 seconds")
    found = out.where("tag = 'match'").select("user", F.col("x.ts").alias("p"), F.col("y.ts").alias("q"))
    assert rows_of(found) == PAIRS


ORDERS = [
    ("in time", 0, "create", 0), ("in time", 100, "look", 0), ("in time", 899, "pay", 0),
    ("edge", 0, "create", 0), ("edge", 900, "pay", 0),
    ("late", 0, "create", 0), ("late", 901, "pay", 0),
    ("pay only", 5, "pay", 0), ("never", 0, "create", 0),
    ("twice", 0, "create", 0), ("twice", 10, "create", 0), ("twice", 20, "pay", 0),
]


def test_relaxed_sequence(spark):
    steps = [Step("c", kind("create")), Step("p", kind("pay"))]
    out = patterns.match_sequence(events(spark, *ORDERS), ["user"], ORDER, steps, "15 minutes")
    assert rows_of(out, "user", "c.ts", "tag") == [
        ("edge", at(0), "timeout"), ("in time", at(0), "match"), ("late", at(0), "timeout"),
        ("never", at(0), "timeout"), ("twice", at(0), "match"), ("twice", at(10), "match"),
    ]


def test_order_status(spark):
    out = alerts.order_status(events(spark, *ORDERS), ["user"], ORDER, kind("create"), kind("pay"), "15 minutes")
    assert {(r[0], r[1]) for r in rows_of(out, "user", "tag")} == {
        ("in time", "paid"), ("edge", "late"), ("late", "late"), ("pay only", "no create"),
        ("never", "timeout"), ("twice", "paid"),
    }


def test_order_check_includes_the_limit(spark):
    out = alerts.order_check(events(spark, *ORDERS), ["user"], ORDER, kind("create"), kind("pay"), "15 minutes")
    assert dict(rows_of(out.where("user in ('edge', 'late', 'never')"), "user", "tag")) == {
        "edge": "paid", "late": "timeout", "never": "timeout",
    }


def test_daily_cap(spark):
    day = 86400
    data = [("a", s, "", 0) for s in (1, 2, 3, 4, day - 0.000001, day, day + 1, day + 2)]
    out = alerts.daily_cap(events(spark, *data), ["user"], ORDER, 2)
    assert rows_of(out, "id", "tag") == [(0, "pass"), (1, "pass"), (2, "warn"), (5, "pass"), (6, "pass"), (7, "warn")]


def test_jump_alert_is_strict_and_skips_first(spark):
    df = events(spark, ("a", 0, "", 50), ("a", 1, "", 60), ("a", 2, "", 71))
    assert rows_of(alerts.jump_alert(df, ["user"], ORDER, "v", 10.0), "v", "previous") == [(71, 60)]


def test_rise_alert(spark):
    df = events(
        spark,
        ("a", 0, "", 5), ("a", 1, "", 6), ("a", 1.5, "", 6), ("a", 2, "", 5),      # falls exactly 1 s later
        ("b", 0, "", 5), ("b", 1, "", 6), ("b", 1.9, "", 5),                        # falls too soon
        ("c", 0, "", 5), ("c", 1, "", 5), ("c", 2, "", 7),                          # never falls
        ("d", 0, "", 5), ("d", 9, "", 5),                                           # never rises
    )
    out = alerts.rise_alert(df, ["user"], ORDER, "v", "1 second")
    assert rows_of(out) == [("a", at(1), at(2)), ("c", at(2), at(3))]


# --- late rows -----------------------------------------------------------------------------


def test_late_rows(spark):
    data = [(1, "a", 10, 1), (2, "a", 2, 2), (2, "a", 8, 4), (2, "a", 30, 8), (3, "a", 21, 16), (3, "a", 3, 32)]
    df = spark.createDataFrame([(b, u, at(s), v) for b, u, s, v in data], "b int, user string, ts timestamp_ntz, v int")
    # Marks before the batches: none, 10 - 3 = 7, 30 - 3 = 27; windows of 5 s, kept 3 s more.
    out = late.split_late(df, "ts", "b", "3 seconds", "5 seconds", "3 seconds")
    assert rows_of(out, "v", "lateness") == [
        (1, "on_time"), (2, "refire"), (4, "on_time"), (8, "on_time"), (16, "refire"), (32, "dropped"),
    ]
    assert rows_of(late.too_late(out)) == [(3, "a", at(3), 32)]
    again = late.refirings(out, ["user"], "b", F.col("v"), "total")
    assert rows_of(again, "window_start", "b", "total") == [(at(0), 2, 2), (at(20), 3, 16)]


# --- spreading and user functions ----------------------------------------------------------


def test_partitioning(spark):
    df = spark.range(11, 101)
    assert df.count() == 90
    counts = dict(rows_of(partition.partition_counts(partition.rebalance(df, 4))))
    assert sum(counts.values()) == 90 and max(counts.values()) - min(counts.values()) <= 8
    assert partition.to_first(df).rdd.getNumPartitions() == 1
    assert rows_of(partition.partition_counts(partition.replicate(df, 3))) == [(i, 90) for i in range(3)]
    by = partition.partition_by(df, 4, F.col("id") % 4)
    assert by.where(F.spark_partition_id() != F.col("id") % 4).count() == 0
    seeded = [rows_of(rows.with_partition(partition.shuffle_random(df, 4, 7))) for _ in range(2)]
    assert seeded[0] == seeded[1] and len({p for _, p in seeded[0]}) == 4


# Test modules are not on the workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Spread(running.UserAggregate):
    def create(self):
        return None

    def add(self, acc, pdf):
        low, high = int(pdf["v"].min()), int(pdf["v"].max())
        return (low, high) if acc is None else (min(acc[0], low), max(acc[1], high))

    def merge(self, a, b):
        return (min(a[0], b[0]), max(a[1], b[1]))

    def result(self, acc):
        return (acc[1] - acc[0],)


def test_user_aggregate_with_null_key(spark):
    df = spark.range(1000).repartition(7).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = running.user_aggregate(df, ["k"], ["v"], Spread(), T.StructType([T.StructField("w", T.LongType())]), fan_in=2, keep=1)
    assert rows_of(out) == [(1, 996), (2, 996), (None, 999)]


def test_hot_null_key_is_sliced(spark, sliced):
    data = [(None, s, "", s) for s in range(40)] + [("a", 3, "", 1)]
    tl = timeline(events(spark, *data), ["user"], ORDER)
    assert tl.sliced and tl.hot_slices > 3
    out = tl.forward(include_current=False, before=nearest("v")).done()
    assert [r[1] for r in rows_of(out.where("user is null"), "id", "before")] == [None, *range(39)]


def test_running_reduce_function_on_slices(spark, sliced):
    data = [(u, s, "", s) for u in ("a", "b") for s in range(20)]
    out = running.running_reduce(events(spark, *data), ["user"], ORDER, ["v"], lambda x, y: (x[0] + y[0],), associative=True)
    assert [r[1] for r in rows_of(out.where("user = 'b'"), "id", "reduced_v")] == [s * (s + 1) // 2 for s in range(20)]


def test_large_caps_are_cut_before_the_shuffle(spark):
    rows_ = spark.range(100_000).select("id", (F.col("id") % 2).alias("user"), F.timestamp_seconds("id").alias("ts"))
    plan = alerts.daily_cap(rows_, ["user"], ["ts", "id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_hot_key_of_one_time_is_cut_by_the_full_order(spark, sliced):
    df = spark.range(100).select(F.lit("a").alias("k"), F.lit(7).alias("t"), F.col("id"))
    line = timeline(df, ["k"], ["t", "id"]).forward(n=running_count())
    assert line.hot.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 3
    assert rows_of(line.done(), "id", "n") == [(i, i + 1) for i in range(100)]


def test_hot_keys_are_scanned_apart(spark, sliced, tmp_path):
    """Ordinary keys keep plain windows; hot keys are written once, however many scans follow."""
    data = [(k, i, i % 7) for k, n in (("hot", 50), (None, 30), ("a", 2), ("b", 1)) for i in range(n)]
    spark.createDataFrame(data, "k string, i int, v int").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in").withColumn("none", F.lit(None))
    line = timeline(df, ["k"], ["i"])
    assert rows_of(line.rows.select("k").distinct()) == [("a",), ("b",)]
    assert line.hot.count() == 80 and line.hot.schema["none"].dataType == T.NullType()
    for _ in range(2):
        line = line.forward(total=running_sum("v")).changed(lambda r: r.withColumn("even", F.col("total") % 2 == 0).drop("total"))
    out = line.forward(n=running_count("even"), total=running_sum("v")).backward(include_current=False, rest=running_sum("v")).done()
    assert out.columns == ["k", "i", "v", "none", "even", "n", "total", "rest"]
    want = []
    for key in ("hot", None, "a", "b"):
        values = [v for k, _, v in data if k == key]
        want += [(key, i, i + 1, sum(values[: i + 1]), sum(values[i + 1 :]) or None) for i in range(len(values))]
    got = {(r.k, r.i): (r.n, r.total, r.rest or None) for r in out.collect()}
    assert got == {w[:2]: w[2:] for w in want}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count(f"{tmp_path}/in") == 1


def test_slices_of_null_order_values(spark, sliced):
    df = spark.createDataFrame([("a", None if i % 5 == 0 else i, i) for i in range(40)], "k string, t int, id int")
    got = rows_of(timeline(df, ["k"], ["t", "id"]).forward(n=running_count()).done(), "id", "n")
    order = sorted(range(40), key=lambda i: (i % 5 > 0, i if i % 5 else 0, i))
    assert got == sorted((i, n + 1) for n, i in enumerate(order))


def test_broadcast_needs_fixed_width_and_few_bytes(spark):
    df = spark.range(5).select("id", F.array(F.struct("id")).alias("a"))
    plan = lambda d, n: broadcast_if_small(d, n)._jdf.queryExecution().analyzed().toString()
    assert fixed_width(df.schema) == 8 + 8 + 16 and fixed_width(df.select(F.lit("x")).schema) is None
    assert "broadcast" in plan(df, 1000) and "broadcast" not in plan(df, 10**9)
    assert "broadcast" not in plan(df.withColumn("s", F.lit("x")), 1)
