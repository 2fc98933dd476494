"""Every registered query against its SQL twin, with whole keys and with sliced ones."""

import compare
import pytest
from conftest import DATA

from evstream.plans.queries import ORACLE, QUERIES

# Rows of these exist only on larger tables.
MAY_BE_EMPTY = {"late_refire", "sql_having"}
SCANS = [
    "uv_bitmap_running", "login_fail_state", "login_fail_pattern", "order_paid", "order_timeout",
    "order_status", "order_check", "sequence_three_steps", "window_members", "traffic_count5",
    "traffic_count5_3", "late_on_time", "late_dropped", "running_sum", "running_max",
    "running_max_by", "running_reduce", "running_reduce_function", "running_min_total",
    "changelog_sum", "changelog_having", "jump_alert", "rise_alert", "traffic_session", "marketing_total",
]


def check(spark, sql, name):
    found = compare.differences(sql, QUERIES[name](spark, DATA), ORACLE[name])
    assert found == "" or (found == "no rows" and name in MAY_BE_EMPTY)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sql, name):
    check(spark, sql, name)


@pytest.mark.parametrize("name", SCANS)
def test_sliced_equals_sql(spark, sql, sliced, name):
    check(spark, sql, name)


def test_sliced_without_broadcast(spark, sql, sliced):
    spark.conf.set("evstream.broadcast.bytes", "0")
    try:
        check(spark, sql, "order_status")
    finally:
        spark.conf.unset("evstream.broadcast.bytes")


def test_slices_found_by_a_sample(spark):
    """A limit above the sample size per slice: hot keys and cut points come from a real sample."""
    folder = DATA.replace("sf0.001", "sf0.01")
    spark.conf.set("evstream.slice.rows", "4000")
    spark.conf.set("evstream.slice.floor.bytes", "0")
    try:
        con = compare.tables(folder)
        for name in ("running_min_total", "late_refire"):
            assert compare.differences(con, QUERIES[name](spark, folder), ORACLE[name]) == ""
    finally:
        spark.conf.unset("evstream.slice.rows")
        spark.conf.unset("evstream.slice.floor.bytes")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["window_end", "item_id", "cnt", "rank"]
    assert entry.queries().keys() >= QUERIES.keys()
