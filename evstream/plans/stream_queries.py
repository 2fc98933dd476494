"""Named queries that run as streams over the tables.

Each drains a stream of ``events`` into a table and returns it. Those by event time end with a
closing row beyond every window and timer, so that their results are those of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evstream.operators import joins, late, rows, windows
from evstream.operators.common import cents
from evstream.operators.patterns import Step
from evstream.operators.running import latest_per_key
from evstream.plans import table_queries as tq
from evstream.plans.jobs import sales_dashboard
from evstream.plans.registry import ORACLE, query
from evstream.schemas import TABLES
from evstream.session import planned_bytes, prepare_streaming, scratch_path
from evstream.sources.groups import GROUP_BYTES, deliver_in_order, row_groups
from evstream.streaming import jobs
from evstream.streaming.runner import Closing, run_to_table, stream_of

BY_ID = ["event_id"]
k_, is_ = tq.k_, tq.is_


def stream(t, keep: Column | None = None) -> DataFrame:
    """The events of ``keep`` as a stream in order of arrival."""
    # A pattern, since a stream takes a single file by pattern only; it fits a folder as well.
    # A key's share of a micro-batch is sorted in memory, hence the limit.
    reader = prepare_streaming(t.spark).readStream.schema(TABLES["events"])
    rows_ = reader.option("maxBytesPerTrigger", str(4 << 30)).parquet(f"{t.folder}/events.parquet*")
    return rows_ if keep is None else rows_.where(keep)


def timed(t, closing: Closing, keep: Column | None = None, bound: str = "0 seconds", change=None) -> DataFrame:
    """The events of ``keep``, put through ``change``, with event time and watermark, ended by the
    closing row. One batch reads all files: their rows need no order between files."""
    reader = prepare_streaming(t.spark).readStream.schema(TABLES["events"])
    rows_ = reader.parquet(f"{t.folder}/events.parquet*")
    rows_ = rows_ if keep is None else rows_.where(keep)
    return jobs.event_time(closing.follow(rows_ if change is None else change(rows_)), "ts", bound)


def in_order(t, closing: Closing, keep: Column, batches: int = 4) -> DataFrame:
    """The events of ``keep`` with event time and watermark, in order of time.

    They are laid out once in that order, and the watermark moves on with every micro-batch, so the
    state holds what is open then and not the table. A micro-batch takes a full row group for each
    core of the cluster, by bytes, since small files cost as much to start as large ones; a table of
    less than ``batches`` such is dealt to about ``batches``.
    """
    folder = scratch_path(prepare_streaming(t.spark), "ordered")
    events, cores = t.events.where(keep), t.spark.sparkContext.defaultParallelism
    deliver_in_order(events, ["ts", *BY_ID], f"{folder}/0", batches * cores)
    written = planned_bytes(t.spark.read.schema(events.schema).parquet(f"{folder}/0"))
    most = min(cores * GROUP_BYTES, -(-written // batches))
    rows_ = row_groups(t.spark, folder, events.schema, bytes_per_batch=most)
    # Rows of one time may stand on both sides of a batch's end: they are not late.
    return jobs.event_time(closing.follow(rows_), "ts", "1 millisecond")


def ends(t, at_once: bool = True) -> Closing:
    """The closing row of the events; at once for :func:`timed`, which reads them in one batch."""
    prepare_streaming(t.spark)
    return Closing(t.events, "ts", at_once)


def drained(t, df: DataFrame, name: str, closing: Closing | None = None, limited: bool = False) -> DataFrame:
    return run_to_table(df, name, source=t.events, closing=closing, limited=limited)


IS_VIEW = "event_type = 'view'"


@query("stream_pv_hourly", f"""
    select date_trunc('hour', ts) as window_start,
           date_trunc('hour', ts) + interval 1 hour as window_end, count(*) as pv
    from events where {IS_VIEW} group by 1, 2""")
def stream_pv_hourly(t):
    end = ends(t)
    views = timed(t, end, is_("view"))
    counts = windows.tumble(views, "ts", "1 hour", [], F.count(F.lit(1)).alias("pv"))
    return drained(t, jobs.plain_times(counts), "pv", end)


@query("stream_pv_in_order", ORACLE["stream_pv_hourly"])
def stream_pv_in_order(t):
    """As :func:`stream_pv_hourly`, over several micro-batches: a window is put out and forgotten
    once the watermark has passed it."""
    end = ends(t, at_once=False)
    counts = windows.tumble(in_order(t, end, is_("view")), "ts", "1 hour", [], F.count(F.lit(1)).alias("pv"))
    return drained(t, jobs.plain_times(counts), "pv-in-order", end, limited=True)


@query("stream_uv_hourly", f"""
    select date_trunc('hour', ts) + interval 1 hour as window_end, count(distinct user_id) as uv
    from events where {IS_VIEW} group by 1""")
def stream_uv_hourly(t):
    end = ends(t)
    return drained(t, jobs.unique_visitors(timed(t, end, is_("view")), "ts", "user_id", "1 hour"), "uv", end)


@query("stream_hot_items_top3", f"""
    with s as (select ts, {tq.SQL_K} as item_id from events where {IS_VIEW}),
    {tq.sliding_sql("s", "item_id", 6 * tq.HOUR, tq.HOUR, "w")}
    select window_end, item_id, cnt, rank from (
      select *, cast(row_number() over (partition by window_end order by cnt desc, item_id) as int) as rank
      from w) where rank <= 3""")
def stream_hot_items_top3(t):
    end = ends(t)
    views = timed(t, end, is_("view")).withColumn("item_id", k_())
    return drained(t, jobs.hot_keys(views, "ts", "item_id", "6 hours", "1 hour", 3), "hot", end)


@query("stream_sessions", """
    with e as (select user_id, ts, case when ts > lag(ts) over w + interval 6 hours
            or lag(ts) over w is null then 1 else 0 end as opened
          from events window w as (partition by user_id order by ts, event_id)),
    s as (select *, sum(opened) over (partition by user_id order by ts) as sid from e)
    select user_id, min(ts) as session_start, max(ts) + interval 6 hours as session_end, count(*) as cnt
    from s group by user_id, sid""")
def stream_sessions(t):
    end = ends(t)
    held = jobs.sessions(timed(t, end), "ts", "6 hours", ["user_id"], F.count(F.lit(1)).alias("cnt"))
    return drained(t, held, "sessions", end)


def _pays_and_receipts(t, end):
    pays = timed(t, end, is_("purchase"), "10 minutes").select(
        F.col("event_id").alias("pay_id"), "user_id", F.col("ts").alias("pay_time")
    )
    receipts = timed(t, end, is_("signup"), "10 minutes").select(
        F.col("event_id").alias("receipt_id"), F.col("user_id").alias("receipt_user"),
        F.col("ts").alias("receipt_time"),
    )
    return pays, receipts


@query("stream_tx_match_inner", f"{tq.TX_SQL} select * from p join r on {tq.TX_ON}")
def stream_tx_match_inner(t):
    end = ends(t)
    pays, receipts = _pays_and_receipts(t, end)
    pairs = jobs.payment_join(pays, receipts, tq.ON_USER, "pay_time", "receipt_time", "1 hour")
    return drained(t, jobs.plain_times(pairs), "tx", end)


@query("stream_tx_match_by_id", ORACLE["tx_match_by_id"])
def stream_tx_match_by_id(t):
    end = ends(t)
    pays = tq.tx_pays(timed(t, end, is_("purchase"), "10 minutes"))
    receipts = tq.tx_receipts(timed(t, end, bound="10 minutes", change=tq.shifted_receipts))
    both = joins.match_by_id(pays, receipts, tq.ON_TX, "pay_time", "receipt_time", "1 hour")
    return drained(t, jobs.plain_times(both), "txid", end)


@query("stream_marketing_by_channel", ORACLE["marketing_by_channel"])
def stream_marketing_by_channel(t):
    end = ends(t)
    used = tq.marketed(timed(t, end, ~is_("signup")))
    return drained(t, jobs.slide_counts(used, "ts", "1 day", "1 hour", ["channel", "behavior"]), "marketing", end)


@query("stream_clicks_by_province", ORACLE["clicks_by_province"])
def stream_clicks_by_province(t):
    """Two queries: the cap by event order, then windows over the clicks that passed."""
    end, folder = ends(t), scratch_path(t.spark, "passed")
    capped = jobs.daily_cap(timed(t, end), ["user_id", "event_type"], BY_ID, 2).where("tag = 'pass'")
    passed = run_to_table(capped, "passed", folder=folder, source=t.events, closing=end)
    end = Closing(passed, "ts", at_once=True)
    clicks = jobs.event_time(end.follow(stream_of(passed, folder)), "ts")
    clicks = clicks.withColumn("province", F.col("user_id") % 5)
    counts = jobs.slide_counts(clicks, "ts", "1 hour", "1 minute", ["province"])
    return drained(t, counts.drop("window_start"), "province", end)


@query("stream_sales_top3", ORACLE["sales_top3"])
def stream_sales_top3(t):
    """The dashboard from the last of the early totals of every category and day."""
    reader = prepare_streaming(t.spark).readStream.schema(TABLES["lineitem"])
    sold = reader.option("maxBytesPerTrigger", str(4 << 30)).parquet(f"{t.folder}/lineitem.parquet*")
    sold = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_shipdate", F.col("p_brand").alias("category"), cents("l_extendedprice").alias("price"))
    told = jobs.early_totals(sold, "l_shipdate", "1 day", ["category"], "price", offset="-8 hours")
    told = run_to_table(told, "sales", source=t.lineitem)
    last = latest_per_key(told, ["window_start", "category"], ["firing"])
    return sales_dashboard(last.withColumnRenamed("total", "cents"), "category")


@query("stream_uv_bitmap", ORACLE["uv_bitmap_running"])
def stream_uv_bitmap(t):
    end = ends(t)
    views = timed(t, end, is_("view"))
    return drained(t, jobs.running_distinct_bitmap(views, "ts", "1 hour", "user_id", BY_ID), "bitmap", end)


DELIVERIES = 3
LATE_STREAM_SQL = tq.LATE_SQL.replace(
    "event_id // 500", f"event_id * {DELIVERIES} // (select max(event_id) + 1 from events)")


@query("stream_late_rows", f"""{LATE_STREAM_SQL}
    select event_id, ts, window_start, window_end, lateness from l""")
def stream_late_rows(t):
    return _delivered(t).select("event_id", "ts", "window_start", "window_end", "lateness")


@query("stream_late_totals", f"""{LATE_STREAM_SQL}
    select user_id, window_start, window_end, cast(sum(c) as bigint) as cents
    from l where lateness = 'on_time' group by 1, 2, 3""")
def stream_late_totals(t):
    """On-time totals, from the same pass over the stream that gives the late rows."""
    return late.first_firing(_delivered(t), ["user_id"], F.sum("c").alias("cents"))


@query("stream_late_refire", f"""{LATE_STREAM_SQL},
    p as (select user_id, window_start, window_end, -1 as arrival, sum(c) as part from l
          where lateness = 'on_time' group by 1, 2, 3
          union all select user_id, window_start, window_end, arrival, sum(c) from l
          where lateness = 'refire' group by 1, 2, 3, 4)
    select user_id, window_start, window_end, row_number() over w as firing, cast(sum(part) over w as bigint) as cents,
           arrival >= 0 as late
    from p window w as (partition by user_id, window_start order by arrival)""")
def stream_late_refire(t):
    """Totals of every user and hour, put out again with every delivery that corrects them."""
    return _delivered_to(t, lambda rows_: jobs.refiring_totals(
        rows_, "ts", ["user_id"], F.col("c"), "3 hours", "1 hour", "3 hours", "cents", _shares(t)), closed=True)


@query("stream_late_top3", f"""{LATE_STREAM_SQL},
    p as (select user_id, window_end, -1 as arrival, count(*) as part from l where lateness = 'on_time' group by 1, 2
          union all select user_id, window_end, arrival, count(*) from l where lateness = 'refire' group by 1, 2, 3),
    f as (select window_end, arrival, row_number() over (partition by window_end order by arrival) as firing
          from (select distinct window_end, arrival from p)),
    c as (select f.window_end, f.firing, p.user_id, cast(sum(p.part) as bigint) as cnt
          from f join p on p.window_end = f.window_end and p.arrival <= f.arrival group by all)
    select window_end, firing, cast(row_number() over w as int) as rank, user_id, cnt from c
    window w as (partition by window_end, firing order by cnt desc, user_id) qualify row_number() over w <= 3""")
def stream_late_top3(t):
    """The three busiest users of every hour, ranked again with every delivery that has late rows."""
    return _delivered_to(t, lambda rows_: jobs.refiring_top(
        rows_, "ts", "user_id", "3 hours", "1 hour", "3 hours", 3, lanes=2, shares=_shares(t)), closed=True)


SHARE_BYTES = 16 << 20


def _shares(t) -> int:
    """Shares of a window's users: even a window that holds all of the table keeps its entries of the state small."""
    return 1 + planned_bytes(t.events) // SHARE_BYTES


def _delivered(t):
    """The events in three deliveries, with what a watermark makes of each row."""
    return _delivered_to(t, lambda rows_: jobs.split_late(rows_, "ts", "user_id", "3 hours", "1 hour", "3 hours"))


def _delivered_to(t, job, closed: bool = False):
    """What ``job`` makes of the events in three deliveries, each a micro-batch of one query."""
    folder = scratch_path(prepare_streaming(t.spark), "deliveries")
    rows_ = tq.shifted_times(t.events)
    ids = t.events.agg(F.max("event_id") + 1).first()[0] or 1
    number = F.call_function("div", F.col("event_id") * DELIVERIES, F.lit(ids))
    rows_.limit(0).write.parquet(f"{folder}/source")
    source = t.spark.readStream.schema(rows_.schema).parquet(f"{folder}/source")
    end = Closing(rows_, "ts") if closed else None
    out = job(end.follow(source) if end else source)
    for n in range(DELIVERIES):
        rows_.where(number == n).write.mode("append").parquet(f"{folder}/source")
        told = run_to_table(out, "late", folder=folder, source=t.events, closing=end if n == DELIVERIES - 1 else None)
    return told


@query("stream_running_reduce", """
    select event_id, user_id, count(*) over w as reduced_n, max(value) over w as reduced_value
    from events window w as (partition by user_id order by ts, event_id)""")
def stream_running_reduce(t):
    rows = stream(t).withColumn("n", F.lit(1).cast("bigint"))
    out = jobs.running_reduce(
        rows, ["user_id"], BY_ID, ["n", "value"], lambda x, y: (x[0] + y[0], max(x[1], y[1]))
    )
    return drained(t, out, "reduce")


@query("stream_running_sum", f"""
    select event_id, event_type, cast(sum({tq.SQL_K}) over (partition by event_type order by event_id) as bigint) as total,
           max({tq.SQL_K}) over (partition by event_type order by event_id) as greatest from events""")
def stream_running_sum(t):
    """Few keys with many rows each: a key's rows are folded in slices of its ids."""
    rows_ = stream(t).select("event_id", "event_type", k_().alias("k"))
    cut = F.call_function("div", F.col("event_id"), F.lit(100))
    total = drained(t, jobs.running_fold(rows_, ["event_type"], BY_ID, "k", cut), "running-sum")
    most = drained(t, jobs.running_fold(rows_, ["event_type"], BY_ID, "k", cut, "max", "greatest"), "running-max")
    return total.join(most.drop("event_type"), "event_id")


@query("stream_count5_3", f"""
    select user_id, rn // 3 as firing, cars from (
      select user_id, rn, cast(sum(k) over (partition by user_id order by rn
             rows between 4 preceding and current row) as bigint) as cars from ({tq.COUNTED_SQL}))
    where rn % 3 = 0""")
def stream_count5_3(t):
    rows = stream(t).withColumn("k", k_())
    return drained(t, jobs.count_windows(rows, ["user_id"], BY_ID, "k", 5, 3, "cars"), "count")


SLICE_BYTES = 1 << 20


def _id_slices(t) -> Column:
    """Numbers stretches of the ids, as many as the table's size asks for, however far apart the ids are."""
    least, most = t.events.agg(F.min("event_id"), F.max("event_id")).first()
    ids = 1 if least is None else most - least + 1
    return F.call_function("div", F.col("event_id"), F.lit(-(-ids // (1 + planned_bytes(t.events) // SLICE_BYTES))))


@query("stream_changelog_sum", f"""{tq.CHANGES_SQL}
    select event_id, word, false as inserted, old_total as frequency from u where old_total is not null
    union all select event_id, word, true, new_total from u""")
def stream_changelog_sum(t):
    """Few words with many rows each: a word's rows are summed up in slices of its ids."""
    words = stream(t).select("event_id", F.col("event_type").alias("word"), k_().alias("k"))
    return drained(t, jobs.changelog(words, ["word"], BY_ID, "k", "frequency", slices=_id_slices(t)), "changes")


@query("stream_jump_alert", """
    select event_id, user_id, value, previous from (
      select *, lag(value) over (partition by user_id order by ts, event_id) as previous from events)
    where abs(value - previous) > 10.0""")
def stream_jump_alert(t):
    end = ends(t)
    return drained(t, jobs.jump_alert(timed(t, end), ["user_id"], BY_ID, "value", 10.0), "jump", end)


@query("stream_rise_alert", """
    with e as (select *, lag(value) over (partition by user_id order by ts, event_id) as prev from events),
    r as (select *, sum(case when value < prev then 1 else 0 end) over (
            partition by user_id order by ts, event_id) as run from e),
    g as (select user_id, run, min(case when value > prev then ts end) as t0, min(ts) as opened
          from r group by 1, 2),
    n as (select *, lead(opened) over (partition by user_id order by run) as fall from g)
    select user_id, t0 as rise_start, t0 + interval 12 hours as alert_time from n
    where t0 is not null and (fall is null or fall >= t0 + interval 12 hours)""")
def stream_rise_alert(t):
    end = ends(t)
    return drained(t, jobs.rise_alert(timed(t, end), ["user_id"], BY_ID, "value", "12 hours"), "rise", end)


@query("stream_click_cap", f"""
    select user_id, event_type, ts, event_id, case when rn = 3 then 'warn' else 'pass' end as tag
    from ({tq.CAP_SQL}) where rn <= 3""")
def stream_click_cap(t):
    end = ends(t)
    return drained(t, jobs.daily_cap(timed(t, end), ["user_id", "event_type"], BY_ID, 2), "cap", end)


@query("stream_login_fail", """
    select user_id, prev as first_fail_time, ts as last_fail_time
    from (select *, lag(ts) over w as prev, lag(event_type) over w as prev_type
          from events window w as (partition by user_id order by ts, event_id))
    where event_type = 'error' and prev_type = 'error' and ts < prev + interval 12 hours""")
def stream_login_fail(t):
    end = ends(t)
    out = jobs.login_failures(timed(t, end), ["user_id"], BY_ID, is_("error"), "12 hours")
    return drained(t, out, "login", end)


SEEN_PAY_SQL = f"with n as ({tq.NEXT_PAY_SQL})"


def _orders(t, end):
    # Other kinds of events have no part in an order's state.
    return timed(t, end, is_("click") | is_("purchase"))


@query("stream_order_status", f"""{SEEN_PAY_SQL}
    select user_id, case when event_type = 'click' then ts end as create_time,
           case when event_type = 'click' then pay else ts end as pay_time,
           case when event_type = 'purchase' then 'no create' when pay is null then 'timeout'
                when pay < ts + interval 1 day then 'paid' else 'late' end as tag
    from n
    where event_type = 'click' or (event_type = 'purchase' and creates = 0)""")
def stream_order_status(t):
    end = ends(t)
    return _order_status(t, _orders(t, end), end)


def _order_status(t, orders, end, limited: bool = False):
    told = jobs.order_status(orders, ["user_id"], BY_ID, is_("click"), is_("purchase"), "1 day")
    told = drained(t, told, "orders", end, limited)
    # A late pay corrects the time-out told before: keep the last word on each create.
    last = told.groupBy("user_id", *BY_ID).agg(F.max(F.struct("pay_time", "create_time", "tag")).alias("s"))
    return last.select("user_id", "s.create_time", "s.pay_time", "s.tag")


@query("stream_order_status_in_order", ORACLE["stream_order_status"])
def stream_order_status_in_order(t):
    """As :func:`stream_order_status`, over several micro-batches: rows wait in state only until the
    next moves the watermark past them, and time-outs are told on the way."""
    end = ends(t, at_once=False)
    return _order_status(t, in_order(t, end, is_("click") | is_("purchase")), end, limited=True)


@query("stream_order_check", f"""{SEEN_PAY_SQL}
    select user_id, ts as create_time,
           case when pay <= ts + interval 1 day then 'paid' else 'timeout' end as tag
    from n where event_type = 'click' and pays = 0""")
def stream_order_check(t):
    end = ends(t)
    out = jobs.order_check(_orders(t, end), ["user_id"], BY_ID, is_("click"), is_("purchase"), "1 day")
    return drained(t, out, "check", end)


@query("stream_order_pattern", f"""{SEEN_PAY_SQL}
    select user_id, event_id as first_id, case when pay < ts + interval 1 day then pay else ts end as last_time,
           case when pay < ts + interval 1 day then 'match' else 'timeout' end as tag
    from n where event_type = 'click'""")
def stream_order_pattern(t):
    steps = [Step("create", is_("click")), Step("pay", is_("purchase"))]
    end = ends(t)
    found = jobs.match_sequence(_orders(t, end), ["user_id"], "event_id", steps, "1 day")
    return drained(t, found, "pattern", end).select("user_id", "first_id", "last_time", "tag")


@query("stream_marked_minimum", """
    select event_type, date_trunc('hour', ts) as window_start,
           date_trunc('hour', ts) + interval 1 hour as window_end, min(value) as min_value
    from events group by all""")
def stream_marked_minimum(t):
    end = ends(t, at_once=False)
    out = jobs.smallest_by_marker(end.follow(stream(t)), "ts", "event_type", "value", is_("click"), "1 hour")
    return drained(t, out, "marked", end)


@query("stream_tx_match_full", ORACLE["tx_match_full"])
def stream_tx_match_full(t):
    end = ends(t)
    pays, receipts = _pays_and_receipts(t, end)
    both = joins.match_within(pays, receipts, tq.ON_USER, "pay_time", "receipt_time", "1 hour")
    return drained(t, jobs.plain_times(both), "txfull", end)


@query("stream_split_high_low", """
    select event_id, value, case when value > 30 then 'high' else 'low' end as tag from events""")
def stream_split_high_low(t):
    events = stream(t).select("event_id", "value")
    return drained(t, rows.tag_rows(events, {"high": F.col("value") > 30}, "low"), "split")


@query("stream_union_distinct", """
    select user_id, event_type from events where value > 20
    union select user_id, event_type from events where value > 10""")
def stream_union_distinct(t):
    a = stream(t).where(F.col("value") > 20).select("user_id", "event_type")
    b = stream(t).where(F.col("value") > 10).select("user_id", "event_type")
    return drained(t, rows.union_distinct(a, b), "union")


@query("stream_sequence_three_steps", """
    with e as (select *, lead(event_type) over w as nxt_type, lead(ts) over w as nxt_ts,
        lead(event_id) over w as nxt_id
      from events window w as (partition by user_id order by ts, event_id)),
    s as (select *, min(case when event_type = 'click' then event_id end) over (
            partition by user_id order by ts, event_id
            rows between 1 following and unbounded following) as second_id from e),
    m as (select s.user_id, s.event_id as first_id, s.ts as first_ts, c.event_id as second_id,
            c.nxt_id as third_id, c.ts < s.ts + interval 2 days as two,
            c.ts < s.ts + interval 2 days and c.nxt_type = 'purchase'
              and c.nxt_ts < s.ts + interval 2 days as three
          from s left join e c on c.event_id = s.second_id where s.event_type = 'view')
    select user_id, first_id, case when three then third_id when two then second_id else first_id end as last_id,
           cast(case when three then 3 when two then 2 else 1 end as int) as matched,
           case when three then 'match' else 'timeout' end as tag
    from m""")
def stream_sequence_three_steps(t):
    steps = [Step("a", is_("view")), Step("b", is_("click")), Step("c", is_("purchase"), strict=True)]
    end = ends(t)
    found = jobs.match_sequence(timed(t, end), ["user_id"], "event_id", steps, "2 days")
    return drained(t, found, "three", end).select("user_id", "first_id", "last_id", "matched", "tag")
