"""Named queries over whole tables: the jobs, and the operators they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from evstream.functions import text
from evstream.functions.time import epoch_us, from_epoch_us, from_millis, from_seconds, readable
from evstream.operators import alerts, joins, late, partition, patterns, rows, running, windows
from evstream.operators.common import cents, from_cents
from evstream.operators.timeline import running_max, running_min, running_sum
from evstream.plans import jobs
from evstream.plans.registry import query
from evstream.schemas import AD_CLICK, CAR_COUNT

ORDER = ["ts", "event_id"]

SQL_K = "cast(json_extract_string(props, '$.k') as bigint)"


def k_():
    """The number in the ``props`` document of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


def is_(kind):
    return F.col("event_type") == kind


def sliding_sql(source: str, key: str, size_us: int, step_us: int, out: str) -> str:
    """Counts per key and sliding window as CTE ``out(key, window_start, window_end, cnt)``."""
    n = size_us // step_us
    cols = f"{key}, " if key else ""
    group = f"group by {cols}e" if key else "group by e"
    return f"""{out} as (
      select {cols}make_timestamp((e - {n}) * {step_us}) as window_start,
             make_timestamp(e * {step_us}) as window_end, count(*) as cnt
      from (select {cols}unnest(generate_series(p + 1, p + {n})) as e
            from (select {cols}epoch_us(ts) // {step_us} as p from {source}))
      {group})"""


SEC = 1_000_000
MIN, HOUR, DAY = 60 * SEC, 3600 * SEC, 86400 * SEC


# --- page views and visitors ---------------------------------------------------------------


@query("pv_hourly", """
    select date_trunc('hour', ts) as window_start,
           date_trunc('hour', ts) + interval 1 hour as window_end, count(*) as pv
    from events where event_type = 'view' group by 1, 2""")
def pv_hourly(t):
    return jobs.page_views(t.events.where(is_("view")), "ts")


@query("uv_hourly", """
    select date_trunc('hour', ts) + interval 1 hour as window_end, count(distinct user_id) as uv
    from events where event_type = 'view' group by 1""")
def uv_hourly(t):
    return jobs.unique_visitors(t.events.where(is_("view")), "ts", "user_id")


@query("uv_bitmap_running", """
    with v as (
      select event_id, ts, date_trunc('hour', ts) + interval 1 hour as window_end,
             list_reduce(list_prepend(0::bigint, list_transform(
               string_split(cast(user_id as varchar), ''), lambda c: ascii(c)::bigint)),
               lambda r, c: (r * 61 + c) & 536870911) as bit
      from events where event_type = 'view'),
    f as (select *, row_number() over (partition by window_end, bit order by ts, event_id) as rn from v)
    select event_id, window_end,
           cast(sum(case when rn = 1 then 1 else 0 end)
                over (partition by window_end order by ts, event_id) as bigint) as uv
    from f""")
def uv_bitmap_running(t):
    views = t.events.where(is_("view")).select("event_id", "ts", "user_id")
    return jobs.unique_visitors_bitmap(views, "ts", "user_id", ORDER).select("event_id", "window_end", "uv")


# --- hot items, marketing, clicks ----------------------------------------------------------


@query("hot_items_top3", f"""
    with s as (select ts, {SQL_K} as item_id from events where event_type = 'view'),
    {sliding_sql("s", "item_id", DAY, HOUR, "w")}
    select window_end, item_id, cnt, rank from (
      select *, cast(row_number() over (partition by window_end order by cnt desc, item_id) as int) as rank
      from w) where rank <= 3""")
def hot_items_top3(t):
    views = t.events.where(is_("view")).select("ts", k_().alias("item_id"))
    return jobs.hot_keys(views, "ts", "item_id", "1 day", "1 hour", 3)


@query("hot_urls_top5", f"""
    with s as (select ts, event_type || '/' || {SQL_K} as url from events),
    {sliding_sql("s", "url", 6 * HOUR, 30 * MIN, "w")}
    select window_end, url, cnt, rank from (
      select *, cast(row_number() over (partition by window_end order by cnt desc, url) as int) as rank
      from w) where rank <= 5""")
def hot_urls_top5(t):
    urls = t.events.select("ts", F.concat_ws("/", "event_type", k_()).alias("url"))
    return jobs.hot_keys(urls, "ts", "url", "6 hours", "30 minutes", 5)


def marketed(events):
    return events.select(
        "ts", F.concat(F.lit("channel"), k_() % 4).alias("channel"), F.col("event_type").alias("behavior"))


@query("marketing_by_channel", f"""
    with s as (select ts, 'channel' || ({SQL_K} % 4) as channel, event_type as behavior
               from events where event_type <> 'signup'),
    {sliding_sql("s", "channel, behavior", DAY, HOUR, "w")}
    select * from w""")
def marketing_by_channel(t):
    used = marketed(t.events.where(~is_("signup")))
    return jobs.marketing(used, "ts", "1 day", "1 hour", ["channel", "behavior"])


@query("marketing_total", f"""
    with s as (select ts from events where event_type <> 'signup'),
    {sliding_sql("s", "", HOUR, 10 * SEC, "w")}
    select *, 'app marketing' as channel, 'total' as behavior from w""")
def marketing_total(t):
    return jobs.marketing(t.events.where(~is_("signup")), "ts", "1 hour", "10 seconds")


CAP_SQL = """select *, row_number() over (
      partition by user_id, event_type, cast(ts as date) order by ts, event_id) as rn from events"""


@query("click_cap_pass", f"""
    select event_id, ts, user_id, event_type from ({CAP_SQL}) where rn <= 2""")
def click_cap_pass(t):
    capped = jobs.ad_clicks(t.events.drop("value", "props"), ["user_id", "event_type"], ORDER, 2)
    return rows.tagged(capped, "pass")


@query("click_cap_blacklist", f"""
    select user_id, event_type, cast(ts as date) as day, 'Click over 2 times today.' as msg
    from ({CAP_SQL}) where rn = 3""")
def click_cap_blacklist(t):
    keys = ["user_id", "event_type"]
    capped = jobs.ad_clicks(t.events.drop("value", "props"), keys, ORDER, 2)
    return jobs.black_list(capped, keys, "ts", 2)


@query("clicks_by_province", f"""
    with s as (select ts, user_id % 5 as province from ({CAP_SQL}) where rn <= 2),
    {sliding_sql("s", "province", HOUR, MIN, "w")}
    select window_end, province, cnt from w""")
def clicks_by_province(t):
    clicks = t.events.select("event_id", "ts", "user_id", "event_type", (F.col("user_id") % 5).alias("province"))
    return jobs.clicks_by_province(
        clicks, ["user_id", "event_type"], ORDER, 2, "province", "1 hour", "1 minute"
    )


# --- logins, orders, payments --------------------------------------------------------------


@query("login_fail_state", """
    select user_id, prev as first_fail_time, ts as last_fail_time, 'login fail in 12 hours.' as msg
    from (select *, lag(ts) over w as prev, lag(event_type) over w as prev_type
          from events window w as (partition by user_id order by ts, event_id))
    where event_type = 'error' and prev_type = 'error' and ts < prev + interval 12 hours""")
def login_fail_state(t):
    return jobs.login_failures(t.events, ["user_id"], ORDER, is_("error"), "12 hours")


@query("login_fail_pattern", """
    select user_id, ts as first_fail_time, nxt as last_fail_time, 'login fail in 12 hours.' as msg
    from (select *, lead(ts) over w as nxt, lead(event_type) over w as nxt_type
          from events window w as (partition by user_id order by ts, event_id))
    where event_type = 'error' and nxt_type = 'error' and nxt < ts + interval 12 hours""")
def login_fail_pattern(t):
    return jobs.login_failures_pattern(t.events, ["user_id"], ORDER, is_("error"), "12 hours")


NEXT_PAY_SQL = """select *,
      min(case when event_type = 'purchase' then ts end) over later as pay,
      sum(case when event_type = 'click' then 1 else 0 end) over sofar as creates,
      sum(case when event_type = 'purchase' then 1 else 0 end) over sofar as pays
    from events
    window later as (partition by user_id order by ts, event_id
                     rows between 1 following and unbounded following),
           sofar as (partition by user_id order by ts, event_id
                     rows between unbounded preceding and current row)"""


@query("order_paid", f"""
    select user_id, ts as create_time, pay as pay_time from ({NEXT_PAY_SQL})
    where event_type = 'click' and pay < ts + interval 1 day""")
def order_paid(t):
    found = jobs.order_payment_pattern(
        t.events, ["user_id"], ORDER, is_("click"), is_("purchase"), "1 day"
    )
    return found.where(F.col("tag") == patterns.MATCH).drop("tag")


@query("order_timeout", f"""
    select user_id, ts as create_time, 'order timeout' as result_msg from ({NEXT_PAY_SQL})
    where event_type = 'click' and (pay is null or pay >= ts + interval 1 day)""")
def order_timeout(t):
    found = jobs.order_payment_pattern(
        t.events, ["user_id"], ORDER, is_("click"), is_("purchase"), "1 day"
    )
    return found.where(F.col("tag") == patterns.TIMEOUT).select(
        "user_id", "create_time", F.lit("order timeout").alias("result_msg")
    )


@query("order_status", f"""
    select user_id, case when event_type = 'click' then ts end as create_time,
           case when event_type = 'click' then pay else ts end as pay_time,
           case when event_type = 'purchase' then 'no create' when pay is null then 'timeout'
                when pay < ts + interval 1 day then 'paid' else 'late' end as tag
    from ({NEXT_PAY_SQL})
    where event_type = 'click' or (event_type = 'purchase' and creates = 0)""")
def order_status(t):
    return alerts.order_status(
        t.events, ["user_id"], ORDER, is_("click"), is_("purchase"), "1 day"
    )


@query("order_check", f"""
    select user_id, ts as create_time,
           case when pay <= ts + interval 1 day then 'paid' else 'timeout' end as tag
    from ({NEXT_PAY_SQL}) where event_type = 'click' and pays = 0""")
def order_check(t):
    return alerts.order_check(t.events, ["user_id"], ORDER, is_("click"), is_("purchase"), "1 day")


@query("sequence_three_steps", """
    with e as (select *, lead(event_type) over w as nxt_type, lead(ts) over w as nxt_ts
               from events window w as (partition by user_id order by ts, event_id)),
    s as (select *, min(case when event_type = 'click' then event_id end) over (
            partition by user_id order by ts, event_id
            rows between 1 following and unbounded following) as second_id from e)
    select s.user_id, s.event_id as first_id, c.event_id as second_id,
           case when c.nxt_type = 'purchase' then c.event_id end as before_third,
           cast(1 + case when c.ts < s.ts + interval 2 days then
                  1 + case when c.nxt_type = 'purchase' and c.nxt_ts < s.ts + interval 2 days
                           then 1 else 0 end else 0 end as int) as matched
    from s left join e c on c.event_id = s.second_id
    where s.event_type = 'view'""")
def sequence_three_steps(t):
    steps = [
        patterns.Step("a", is_("view")),
        patterns.Step("b", is_("click")),
        patterns.Step("c", is_("purchase"), strict=True),
    ]
    found = patterns.match_sequence(t.events, ["user_id"], ORDER, steps, "2 days")
    return found.select(
        "user_id",
        F.col("a.event_id").alias("first_id"),
        F.col("b.event_id").alias("second_id"),
        F.when(F.col("c.event_id").isNotNull(), F.col("b.event_id")).alias("before_third"),
        "matched",
    )


def _pays(t):
    return t.events.where(is_("purchase")).select(
        F.col("event_id").alias("pay_id"), "user_id", F.col("ts").alias("pay_time")
    )


def _receipts(t):
    return t.events.where(is_("signup")).select(
        F.col("event_id").alias("receipt_id"),
        F.col("user_id").alias("receipt_user"),
        F.col("ts").alias("receipt_time"),
    )


ON_USER = [("user_id", "receipt_user")]

TX_SQL = """with p as (select event_id as pay_id, user_id, ts as pay_time
                       from events where event_type = 'purchase'),
    r as (select event_id as receipt_id, user_id as receipt_user, ts as receipt_time
          from events where event_type = 'signup')"""
TX_ON = """p.user_id = r.receipt_user
      and r.receipt_time between p.pay_time - interval 1 hour and p.pay_time + interval 1 hour"""


@query("tx_match_inner", f"{TX_SQL} select * from p join r on {TX_ON}")
def tx_match_inner(t):
    return jobs.payment_join(_pays(t), _receipts(t), ON_USER, "pay_time", "receipt_time", "1 hour")


@query("tx_match_full", f"""{TX_SQL}
    select *, case when r.receipt_id is null then 'left_only' when p.pay_id is null
              then 'right_only' else 'match' end as tag
    from p full outer join r on {TX_ON}""")
def tx_match_full(t):
    return jobs.payment_matching(_pays(t), _receipts(t), ON_USER, "pay_time", "receipt_time", "1 hour")


# A transaction's id occurs once on a side; some rows have none, and some receipts have no pay.
# Receipts come up to one and a half hours before or after, more than the hour waited for.
RECEIPT_SHIFT = "(event_id * 7919) % 10800 - 5400"
TX_ID_SQL = f"""with p as (select event_id as pay_id, case when event_id % 11 > 0 then event_id end as tx_id, ts as pay_time
                       from events where event_type = 'purchase'),
    r as (select event_id as receipt_id, case when event_id % 13 > 0 then event_id end as receipt_tx,
                 ts + to_seconds({RECEIPT_SHIFT}) as receipt_time
          from events where event_type = 'signup' or (event_type = 'purchase' and event_id % 3 > 0))"""
ON_TX = [("tx_id", "receipt_tx")]


def shifted_receipts(events):
    """Receipts of the events, their time as ``ts``."""
    kept = events.where(is_("signup") | (is_("purchase") & (F.col("event_id") % 3 > 0)))
    return kept.withColumn("ts", from_epoch_us(epoch_us("ts") + F.expr(RECEIPT_SHIFT) * 1_000_000).cast("timestamp_ntz"))


def tx_pays(events):
    return events.select(
        F.col("event_id").alias("pay_id"), F.expr("case when event_id % 11 > 0 then event_id end").alias("tx_id"),
        F.col("ts").alias("pay_time"))


def tx_receipts(events):
    return events.select(
        F.col("event_id").alias("receipt_id"),
        F.expr("case when event_id % 13 > 0 then event_id end").alias("receipt_tx"), F.col("ts").alias("receipt_time"))


@query("tx_match_by_id", f"""{TX_ID_SQL}
    select *, case when r.receipt_id is null then 'left_only' when p.pay_id is null
              then 'right_only' else 'match' end as tag
    from p full outer join r on p.tx_id = r.receipt_tx
      and r.receipt_time between p.pay_time - interval 1 hour and p.pay_time + interval 1 hour""")
def tx_match_by_id(t):
    return joins.match_by_id(
        tx_pays(t.events.where(is_("purchase"))), tx_receipts(shifted_receipts(t.events)), ON_TX,
        "pay_time", "receipt_time", "1 hour")


# --- sales dashboard -----------------------------------------------------------------------

SALES_SQL = """select date_trunc('day', l_shipdate + interval 8 hours) - interval 8 hours as day,
      p_brand as category, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents
    from lineitem join part on l_partkey = p_partkey group by 1, 2"""


def _sales(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_shipdate", F.col("p_brand").alias("category"), "l_extendedprice"
    )
    return jobs.sales_by_category(sold, "l_shipdate", "category", "l_extendedprice")


@query("sales_by_category_day", f"""
    select day, day + interval 1 day as day_end, category, cast(cents as double) / 100.0 as total_price
    from ({SALES_SQL})""")
def sales_by_category_day(t):
    return _sales(t).select(
        F.col("window_start").alias("day"),
        F.col("window_end").alias("day_end"),
        "category",
        from_cents("cents").alias("total_price"),
    )


@query("sales_top3", f"""
    with s as ({SALES_SQL})
    select day, rank, category, cast(cents as double) / 100.0 as total_price,
           cast(total as double) / 100.0 as total from (
      select *, cast(row_number() over (partition by day order by cents desc, category) as int) as rank,
             sum(cents) over (partition by day) as total from s) where rank <= 3""")
def sales_top3(t):
    return jobs.sales_dashboard(_sales(t), "category")


# --- windows -------------------------------------------------------------------------------


@query("min_value_window", f"""
    select make_timestamp(epoch_us(ts) // {10 * SEC} * {10 * SEC}) as window_start,
           make_timestamp((epoch_us(ts) // {10 * SEC} + 1) * {10 * SEC}) as window_end,
           user_id, min(value) as min_value from events group by all""")
def min_value_window(t):
    return jobs.smallest_value(t.events, "ts", "user_id", "value", "10 seconds")


@query("tumble_count_max_min", f"""
    select make_timestamp(epoch_us(ts) // {5 * SEC} * {5 * SEC}) as window_start,
           make_timestamp((epoch_us(ts) // {5 * SEC} + 1) * {5 * SEC}) as window_end,
           user_id, count(event_id) as total_count, max(value) as max_money, min(value) as min_money
    from events group by all""")
def tumble_count_max_min(t):
    return windows.tumble(
        t.events, "ts", "5 seconds", ["user_id"],
        F.count("event_id").alias("total_count"),
        F.max("value").alias("max_money"),
        F.min("value").alias("min_money"),
    )


@query("window_members", """
    with m as (select *, date_trunc('hour', ts) as window_start,
                 (row_number() over (partition by event_type, date_trunc('hour', ts)
                                     order by ts, event_id) - 1) // 3 as page from events)
    select event_type, window_start, window_start + interval 1 hour as window_end, page,
           count(*) as cnt, string_agg(strftime(ts, '%H:%M:%S'), ',' order by ts, event_id) as members
    from m group by event_type, window_start, page""")
def window_members(t):
    return windows.window_members(t.events, "ts", "1 hour", ["event_type"], "event_id", page=3)


@query("traffic_tumble", f"""
    select make_timestamp(epoch_us(ts) // {5 * SEC} * {5 * SEC}) as window_start,
           make_timestamp((epoch_us(ts) // {5 * SEC} + 1) * {5 * SEC}) as window_end,
           user_id, cast(sum({SQL_K}) as bigint) as cars from events group by all""")
def traffic_tumble(t):
    return windows.tumble(t.events, "ts", "5 seconds", ["user_id"], F.sum(k_()).alias("cars"))


@query("traffic_slide", f"""
    select user_id, make_timestamp((e - 2) * {5 * SEC}) as window_start,
           make_timestamp(e * {5 * SEC}) as window_end, cast(sum(k) as bigint) as cars
    from (select user_id, {SQL_K} as k,
                 unnest(generate_series(epoch_us(ts) // {5 * SEC} + 1, epoch_us(ts) // {5 * SEC} + 2)) as e
          from events) group by user_id, e""")
def traffic_slide(t):
    return windows.slide(
        t.events, "ts", "10 seconds", "5 seconds", ["user_id"], sums={"cars": k_()}, count=None
    )


@query("slide_extremes", f"""
    select event_type, make_timestamp((e - 12) * {10 * MIN}) as window_start,
           make_timestamp(e * {10 * MIN}) as window_end, count(*) as cnt,
           cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents,
           min(value) as low, max(value) as high
    from (select event_type, value, unnest(generate_series(
            epoch_us(ts) // {10 * MIN} + 1, epoch_us(ts) // {10 * MIN} + 12)) as e from events)
    group by event_type, e""")
def slide_extremes(t):
    return windows.slide(
        t.events, "ts", "2 hours", "10 minutes", ["event_type"], sums={"cents": cents("value")},
        extremes={"low": ("min", F.col("value")), "high": ("max", F.col("value"))},
    )


COUNTED_SQL = f"""select user_id, {SQL_K} as k,
      row_number() over (partition by user_id order by ts, event_id) as rn from events"""


@query("traffic_count5", f"""
    select user_id, (rn - 1) // 5 + 1 as firing, cast(sum(k) as bigint) as cars
    from ({COUNTED_SQL}) group by 1, 2 having count(*) = 5""")
def traffic_count5(t):
    return windows.count_tumble(t.events, ["user_id"], ORDER, 5, cars=k_())


@query("traffic_count5_3", f"""
    select user_id, rn // 3 as firing, cars from (
      select user_id, rn, cast(sum(k) over (partition by user_id order by rn
             rows between 4 preceding and current row) as bigint) as cars from ({COUNTED_SQL}))
    where rn % 3 = 0""")
def traffic_count5_3(t):
    return windows.count_slide(t.events, ["user_id"], ORDER, 5, 3, cars=k_())


@query("traffic_session", f"""
    with e as (select user_id, ts, {SQL_K} as k, case when ts > lag(ts) over w + interval 6 hours
                 or lag(ts) over w is null then 1 else 0 end as opened
               from events window w as (partition by user_id order by ts, event_id)),
    s as (select *, sum(opened) over (partition by user_id order by ts) as sid from e)
    select user_id, min(ts) as session_start, max(ts) + interval 6 hours as session_end,
           count(*) as cnt, cast(sum(k) as bigint) as cars from s group by user_id, sid""")
def traffic_session(t):
    return windows.sessions(t.events, "ts", "6 hours", ["user_id"], sums={"cars": k_()})


# --- late rows -----------------------------------------------------------------------------

LATE_SQL = f"""with a as (
      select event_id, event_id // 500 as arrival, user_id, cast(round(value * 100) as bigint) as c,
             ts - to_hours(event_id * 7919 % 20) as ts from events),
    b as (select arrival, max(max(ts)) over (order by arrival
            rows between unbounded preceding and 1 preceding) - interval 3 hours as wm
          from a group by arrival),
    l as (select a.*, date_trunc('hour', ts) as window_start,
                 date_trunc('hour', ts) + interval 1 hour as window_end,
                 case when wm is null or date_trunc('hour', ts) + interval 1 hour > wm then 'on_time'
                      when date_trunc('hour', ts) + interval 4 hours > wm then 'refire'
                      else 'dropped' end as lateness
          from a join b using (arrival))"""


def shifted_times(events):
    """The events with times up to 19 hours back, so that some come late."""
    return events.select(
        "event_id",
        "user_id",
        cents("value").alias("c"),
        from_epoch_us(epoch_us("ts") - F.pmod(F.col("event_id") * 7919, F.lit(20)) * HOUR).alias("ts"),
    )


def _late(t):
    arrival = F.call_function("div", F.col("event_id"), F.lit(500))
    shifted = shifted_times(t.events).withColumn("arrival", arrival)
    return jobs.totals_with_late_rows(shifted, "ts", "arrival", "3 hours", "1 hour", "3 hours")


@query("late_on_time", f"""{LATE_SQL}
    select user_id, window_start, window_end, cast(sum(c) as double) / 100.0 as money
    from l where lateness = 'on_time' group by 1, 2, 3""")
def late_on_time(t):
    return late.first_firing(_late(t), ["user_id"], from_cents(F.sum("c")).alias("money"))


@query("late_refire", f"""{LATE_SQL},
    p as (select user_id, window_start, window_end, arrival, sum(c) as part,
                 max(case when lateness = 'refire' then 1 else 0 end) as late
          from l where lateness <> 'dropped' group by 1, 2, 3, 4)
    select user_id, window_start, window_end, arrival, cast(total as double) / 100.0 as money from (
      select *, sum(part) over (partition by user_id, window_start order by arrival) as total from p)
    where late = 1""")
def late_refire(t):
    again = late.refirings(_late(t), ["user_id"], "arrival", F.col("c"), "total")
    return again.withColumn("money", from_cents("total")).drop("total")


@query("late_dropped", f"""{LATE_SQL}
    select event_id, arrival, user_id, cast(c as double) / 100.0 as money, ts
    from l where lateness = 'dropped'""")
def late_dropped(t):
    return late.too_late(_late(t)).select(
        "event_id", "arrival", "user_id", from_cents("c").alias("money"), "ts"
    )


# --- word counts ---------------------------------------------------------------------------


@query("wordcount_space", r"""
    with l as (select unnest(string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n')) as line
               from documents where text <> ''),
    w as (select unnest(case when line <> '' and rtrim(line, ' ') = '' then []
                        else string_split(rtrim(line, ' '), ' ') end) as word from l)
    select word, count(*) as cnt from w group by word""")
def wordcount_space(t):
    return rows.word_count(t.documents, "text", "space")


@query("wordcount_ws", r"""
    with w as (select unnest(string_split_regex(text, '\s')) as word from documents)
    select word, count(*) as cnt from w where word <> '' group by word""")
def wordcount_ws(t):
    return rows.word_count(t.documents, "text", "whitespace")


@query("wordcount_nonword", r"""
    with w as (select unnest(string_split_regex(lower(text), '\W+')) as word from documents)
    select word, count(*) as cnt from w where word <> '' group by word""")
def wordcount_nonword(t):
    return rows.word_count(t.documents, "text", "lowered")


# --- running values, change logs -----------------------------------------------------------


@query("running_sum", """
    select event_id, user_id, cast(sum(cast(round(value * 100) as bigint)) over (
      partition by user_id order by ts, event_id) as double) / 100.0 as total from events""")
def running_sum_(t):
    out = running.running(
        t.events.select("event_id", "user_id", "ts", cents("value").alias("c")),
        ["user_id"], ORDER, total=running_sum("c"),
    )
    return out.select("event_id", "user_id", from_cents("total").alias("total"))


@query("running_max", """
    select event_id, user_id, value, max(value) over w as max_value
    from events window w as (partition by user_id order by ts, event_id)""")
def running_max_(t):
    out = running.running(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ORDER, max_value=running_max("value")
    )
    return out.drop("ts")


@query("running_max_by", """
    select event_id, user_id, arg_max(event_id, (value, -event_id)) over w as max_event_id
    from events window w as (partition by user_id order by ts, event_id)""")
def running_max_by(t):
    out = running.running_max_by(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ORDER, "value", ["event_id"]
    )
    return out.select("event_id", "user_id", "max_event_id")


@query("running_reduce", """
    select event_id, user_id, first_value(event_type) over w as reduced_event_type,
           first_value(k) over w + row_number() over w - 1 as reduced_k,
           case when row_number() over w = 1 then value else value + 10.0 end as reduced_value
    from (select *, %s as k from events) window w as (partition by user_id order by ts, event_id)
    """ % SQL_K)
def running_reduce(t):
    events = t.events.select("event_id", "user_id", "ts", "event_type", "value", k_().alias("k"))
    out = running.running_field_reduce(
        events, ["user_id"], ORDER, "event_type", ("k", 1), ("value", 10.0)
    )
    return out.select("event_id", "user_id", "reduced_event_type", "reduced_k", "reduced_value")


@query("running_reduce_function", """
    select event_id, user_id, count(*) over w as reduced_n, min(value) over w as reduced_value
    from events window w as (partition by user_id order by ts, event_id)""")
def running_reduce_function(t):
    counted = t.events.select("event_id", "user_id", "ts", F.lit(1).cast("bigint").alias("n"), "value")
    out = running.running_reduce(
        counted, ["user_id"], ORDER, ["n", "value"], lambda x, y: (x[0] + y[0], min(x[1], y[1])),
        associative=True,
    )
    return out.select("event_id", "user_id", "reduced_n", "reduced_value")


@query("running_min_total", """
    select event_id, min(value) over w as lowest, cast(sum(1) over w as bigint) as n
    from events window w as (order by ts, event_id)""")
def running_min_total(t):
    out = running.running(
        t.events.select("event_id", "ts", "value"), [], ORDER, lowest=running_min("value"),
        n=running_sum(F.lit(1).cast("bigint")),
    )
    return out.select("event_id", "lowest", "n")


CHANGES_SQL = f"""with r as (
      select event_id, ts, event_type as word, k, sum(k) over w as new_total,
             case when row_number() over w > 1 then sum(k) over w - k end as old_total
      from (select *, {SQL_K} as k from events) window w as (partition by event_type order by ts, event_id)),
    u as (select event_id, ts, word, cast(old_total as bigint) as old_total,
                 cast(new_total as bigint) as new_total from r
          where old_total is distinct from new_total)"""


@query("changelog_sum", f"""{CHANGES_SQL}
    select event_id, ts, word, false as inserted, old_total as frequency from u where old_total is not null
    union all select event_id, ts, word, true, new_total from u""")
def changelog_sum(t):
    words = t.events.select("event_id", "ts", F.col("event_type").alias("word"), k_().alias("k"))
    return running.changelog(words, ["word"], ORDER, "k", "frequency")


@query("changelog_having", f"""{CHANGES_SQL}
    select event_id, ts, word, false as inserted, old_total as frequency from u where old_total % 10 = 2
    union all select event_id, ts, word, true, new_total from u where new_total % 10 = 2""")
def changelog_having(t):
    words = t.events.select("event_id", "ts", F.col("event_type").alias("word"), k_().alias("k"))
    return running.changelog(words, ["word"], ORDER, "k", "frequency", having=lambda c: c % 10 == 2)


@query("latest_per_key", """
    select user_id, max(ts) as ts, arg_max(event_id, ts) as event_id,
           arg_max(event_type, ts) as event_type, arg_max(value, ts) as value
    from events group by user_id""")
def latest_per_key(t):
    return running.latest_per_key(t.events.drop("props"), ["user_id"], ORDER)


# --- alerts --------------------------------------------------------------------------------


@query("jump_alert", """
    select event_id, user_id, value, previous from (
      select *, lag(value) over (partition by user_id order by ts, event_id) as previous from events)
    where abs(value - previous) > 10.0""")
def jump_alert(t):
    events = t.events.select("event_id", "ts", "user_id", "value")
    return alerts.jump_alert(events, ["user_id"], ORDER, "value", 10.0).drop("ts")


@query("rise_alert", """
    with e as (select *, lag(value) over (partition by user_id order by ts, event_id) as prev from events),
    r as (select *, sum(case when value < prev then 1 else 0 end) over (
            partition by user_id order by ts, event_id) as run from e),
    g as (select user_id, run, min(case when value > prev then ts end) as t0, min(ts) as opened
          from r group by 1, 2),
    n as (select *, lead(opened) over (partition by user_id order by run) as fall from g)
    select user_id, t0 as rise_start, t0 + interval 12 hours as alert_time from n
    where t0 is not null and (fall is null or fall >= t0 + interval 12 hours)""")
def rise_alert(t):
    return alerts.rise_alert(t.events, ["user_id"], ORDER, "value", "12 hours")


# --- routing and merging -------------------------------------------------------------------


def _split(t):
    events = t.events.select("event_id", "value")
    return rows.tag_rows(events, {"high": F.col("value") > 30}, otherwise="low")


@query("split_high_low", """
    select event_id, value, case when value > 30 then 'high' else 'low' end as tag from events""")
def split_high_low(t):
    return _split(t)


@query("side_output_odd_even", """
    select 'odd' as side, event_id from events where event_id % 2 = 1
    union all select 'even', event_id from events where event_id % 2 = 0""")
def side_output_odd_even(t):
    routed = rows.tag_rows(t.events.select("event_id"), {"odd": F.col("event_id") % 2 == 1}, "even")
    odd, even = rows.tagged(routed, "odd"), rows.tagged(routed, "even")
    return rows.union_all(odd.select(F.lit("odd").alias("side"), "event_id"),
                          even.select(F.lit("even").alias("side"), "event_id"))


@query("side_output_alert", """
    select event_id, case when value < 32 then 'freezing alert' else 'main' end as tag,
           case when value < 32 then 'freezing alert for ' || user_id end as alert from events""")
def side_output_alert(t):
    low = F.col("value") < 32
    routed = rows.tag_rows(t.events, {"freezing alert": low})
    return routed.select(
        "event_id", "tag", F.when(low, F.concat(F.lit("freezing alert for "), F.col("user_id"))).alias("alert")
    )


@query("union_all", """
    select event_id, value from events where value > 30
    union all select event_id, value from events where not value > 30
    union all select event_id, value from events""")
def union_all(t):
    routed = _split(t)
    return rows.union_all(
        rows.tagged(routed, "high"), rows.tagged(routed, "low"), rows.tagged(routed, "high", "low")
    )


@query("union_distinct", """
    select user_id, event_type from events where value > 20
    union select o_custkey, o_orderpriority from orders where o_totalprice > 100000""")
def union_distinct(t):
    a = t.events.where(F.col("value") > 20).select("user_id", "event_type")
    b = t.orders.where(F.col("o_totalprice") > 100000).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("event_type")
    )
    return rows.union_distinct(a, b)


@query("connect_map", """
    select event_id as id, 'warning' as kind, value as amount, null as status from events
    union all select o_orderkey, 'healthy', null, o_orderstatus from orders""")
def connect_map(t):
    return rows.connect(
        t.events,
        t.orders,
        lambda e: e.select(F.col("event_id").alias("id"), F.lit("warning").alias("kind"), F.col("value").alias("amount")),
        lambda o: o.select(F.col("o_orderkey").alias("id"), F.lit("healthy").alias("kind"), F.col("o_orderstatus").alias("status")),
    )


@query("filter_forms", """
    select event_id, event_type from events
    where event_type <> 'signup' and value > 10 and event_type like '%e%' and not starts_with(event_type, 'p')
      and event_type <> ''""")
def filter_forms(t):
    kind = F.col("event_type")
    return t.events.where(
        (kind != "signup") & (F.col("value") > 10) & kind.contains("e") & ~kind.startswith("p") & (kind != "")
    ).select("event_id", "event_type")


# --- parsing and formatting ----------------------------------------------------------------


@query("parse_delimited", """
    select user_id, event_id as ad_id, event_type as province, 'city ' || (user_id % 7) as city,
           cast(floor(epoch(ts)) as bigint) as timestamp from events""")
def parse_delimited(t):
    city = F.concat(F.lit("city "), F.col("user_id") % 7)
    lines = t.events.select(
        F.concat_ws(" , ", "user_id", "event_id", "event_type", city, F.unix_seconds(F.col("ts").cast("timestamp")),
                    F.lit("surplus")).alias("value")
    )
    return rows.parse_delimited(lines, AD_CLICK)


@query("parse_access_log", """
    select '10.0.0.' || (user_id % 256) as ip, cast(user_id as varchar) as user_id,
           date_trunc('second', ts) as event_time, 'GET' as method, '/' || event_type as url from events""")
def parse_access_log(t):
    lines = t.events.select(
        F.concat_ws(" ", F.concat(F.lit("10.0.0."), F.col("user_id") % 256), "user_id", F.lit("-"),
                    F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"),
                    F.concat(F.lit("/"), F.col("event_type"))).alias("value")
    )
    return rows.parse_access_log(lines)


@query("parse_spaced", f"""
    select cast(user_id as varchar) as sensor_id, cast({SQL_K} as int) as count from events""")
def parse_spaced(t):
    return rows.parse_delimited(t.events.select(F.concat_ws(" ", "user_id", k_()).alias("value")), CAR_COUNT, sep=" ")


@query("json_filter_project", f"""
    select event_id, {SQL_K} as k from events where {SQL_K} >= 50""")
def json_filter_project(t):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return rows.parse_json(t.events, schema, "props", keep=["event_id"]).where(F.col("k") >= 50)


@query("json_forward", """
    select '{"user_id":' || user_id || ',"page_id":' || event_id || ',"status":"success"}' as value
    from events where event_type = 'purchase'""")
def json_forward(t):
    status = F.when(is_("purchase"), "success").otherwise("fail")
    seen = t.events.select("user_id", F.col("event_id").alias("page_id"), status.alias("status"))
    return jobs.forward_json(seen, F.col("status") == "success", "user_id", "page_id", "status")


@query("json_documents", """
    select '{"sensor_id":"' || user_id || '","temperature":"' || value || '","ts":"' ||
           (epoch_us(ts) // 1000) || '"}' as value from events""")
def json_documents(t):
    doc = F.struct(
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("value").cast("string").alias("temperature"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("ts"),
    )
    return t.events.select(F.to_json(doc).alias("value"))


@query("format_rows", """
    select event_id, 'Event(' || event_id || ',' || event_type || ')' as record,
           event_type || ':::' || user_id as pair from events""")
def format_rows(t):
    return t.events.select(
        "event_id", text.record_text("Event", "event_id", "event_type").alias("record"),
        text.joined(":::", "event_type", "user_id").alias("pair"),
    )


@query("time_formats", """
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as full_text, strftime(ts, '%I:%M:%S') as half_day,
           date_trunc('second', ts) as from_s, date_trunc('milliseconds', ts) as from_ms from events""")
def time_formats(t):
    at = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        readable("ts").alias("full_text"),
        readable("ts", "hh:mm:ss").alias("half_day"),
        from_seconds(F.unix_seconds(at)).cast("timestamp_ntz").alias("from_s"),
        from_millis(F.unix_millis(at)).cast("timestamp_ntz").alias("from_ms"),
    )


# --- spreading -----------------------------------------------------------------------------


@query("rebalance_counts", "select count(*) as cnt from events where event_id > 10")
def rebalance_counts(t):
    spread = partition.rebalance(t.events.where(F.col("event_id") > 10), 8)
    return partition.partition_counts(spread).agg(F.sum("cnt").alias("cnt"))


@query("custom_partition_counts", """
    select cast(user_id % 4 as int) as partition, count(*) as cnt from events group by 1""")
def custom_partition_counts(t):
    return partition.partition_counts(partition.partition_by(t.events, 4, F.col("user_id") % 4))


@query("replicated_counts", """
    select cast(c as int) as partition, count(*) as cnt
    from nation, (select unnest(generate_series(0, 3)) as c) group by 1""")
def replicated_counts(t):
    return partition.partition_counts(partition.replicate(t.nation, 4))


# --- SQL surface ---------------------------------------------------------------------------


@query("sql_group_sum", f"""
    select event_type as word, cast(sum({SQL_K}) as bigint) as frequency from events group by 1""")
def sql_group_sum(t):
    t.events.select(F.col("event_type").alias("word"), k_().alias("frequency")).createOrReplaceTempView("words")
    return t.spark.sql("select word, sum(frequency) as frequency from words group by word")


@query("sql_having", f"""
    select user_id, cast(sum({SQL_K}) as bigint) as frequency from events group by 1 having frequency > 3000""")
def sql_having(t):
    totals = t.events.groupBy("user_id").agg(F.sum(k_()).alias("frequency"))
    return totals.where(F.col("frequency") > 3000)


@query("sql_union", """
    select o_custkey as user, o_orderpriority as product from orders where o_totalprice > 200000
    union select user_id, event_type from events where value > 10""")
def sql_union(t):
    t.orders.selectExpr("o_custkey as user", "o_orderpriority as product", "o_totalprice as amount") \
        .createOrReplaceTempView("order_a")
    t.events.selectExpr("user_id as user", "event_type as product", "value as amount") \
        .createOrReplaceTempView("order_b")
    return t.spark.sql("""select user, product from order_a where amount > 200000
                          union select user, product from order_b where amount > 10""")


@query("sql_tumble", f"""
    select user_id, make_timestamp(epoch_us(ts) // {5 * MIN} * {5 * MIN}) as window_start,
           count(event_id) as total_count, max(value) as max_money, min(value) as min_money
    from events group by all""")
def sql_tumble(t):
    t.events.createOrReplaceTempView("money_events")
    return t.spark.sql("""
        select user_id, window.start as window_start, count(event_id) as total_count,
               max(value) as max_money, min(value) as min_money
        from money_events group by user_id, window(ts, '5 minutes')""")


@query("channel_starts", f"""
    select make_timestamp(epoch_us(ts) // {10 * SEC} * {10 * SEC}) as window_start,
           make_timestamp((epoch_us(ts) // {10 * SEC} + 1) * {10 * SEC}) as window_end,
           event_type as ch, count(*) as cnt
    from events where event_type = 'click' group by all""")
def channel_starts(t):
    return jobs.channel_starts(t.events.withColumnRenamed("event_type", "ch"), "ts", "ch", "click")


# --- user-defined aggregate ----------------------------------------------------------------


class CentsAverage(running.UserAggregate):
    """Sum divided by count, over whole cents."""

    def create(self):
        return (0, 0)

    def add(self, acc, rows):
        return (acc[0] + int(rows["c"].sum()), acc[1] + len(rows))

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def result(self, acc):
        return (acc[1], acc[0] / acc[1])


@query("user_aggregate_avg", """
    select event_type, count(*) as n, cast(sum(cast(round(value * 100) as bigint)) as double) / count(*) as avg_cents
    from events group by 1""")
def user_aggregate_avg(t):
    money = t.events.select("event_type", cents("value").alias("c"))
    result = T.StructType([T.StructField("n", T.LongType()), T.StructField("avg_cents", T.DoubleType())])
    return running.user_aggregate(money, ["event_type"], ["c"], CentsAverage(), result)


@query("user_map_partitions", """
    select event_id, upper(event_type) as label from events""")
def user_map_partitions(t):
    return running.map_partitions(
        t.events.select("event_id", "event_type"),
        "event_id bigint, label string",
        lambda: str.upper,
        lambda upper, pdf: pdf.assign(label=pdf["event_type"].map(upper, na_action="ignore"))[["event_id", "label"]],
    )
