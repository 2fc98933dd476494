"""Record schemas: the inputs the jobs read, and the tables that stand in for them."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SENSOR = _schema("id string, timestamp bigint, temperature double")
USER_BEHAVIOR = _schema("user_id bigint, item_id bigint, category_id int, behavior string, timestamp bigint")
ACCESS_LOG = _schema("ip string, user_id string, event_time timestamp_ntz, method string, url string")
AD_CLICK = _schema("user_id bigint, ad_id bigint, province string, city string, timestamp bigint")
LOGIN = _schema("user_id bigint, ip string, event_type string, event_time bigint")
ORDER_EVENT = _schema("order_id bigint, event_type string, tx_id string, event_time bigint")
RECEIPT = _schema("tx_id string, pay_channel string, event_time bigint")
MARKETING = _schema("user_id string, behavior string, channel string, timestamp bigint")
CAR_COUNT = _schema("sensor_id string, count int")
STREAM_ORDER = _schema("order_id string, user_id int, money int, event_time bigint")
TABLE_ORDER = _schema("user bigint, product string, amount int")
WORD = _schema("word string, frequency int")
CITY_VALUE = _schema("city string, v bigint")
STUDENT = _schema("id int, name string, age int")
APP_LOG = _schema("mid string, ch string")
STARTUP_LOG = _schema(
    "mid string, uid string, appid string, area string, os string, ch string, logType string, "
    "vs string, logDate string, logHour string, logHourMinute string, ts bigint"
)
PAGE_STATUS = _schema("user_id bigint, page_id bigint, status string")
CATEGORY_SALE = _schema("category string, price double")

TABLES = {
    "region": _schema("r_regionkey int, r_name string"),
    "nation": _schema("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _schema(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": _schema("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _schema(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": _schema(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _schema(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _schema(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": _schema("doc_id bigint, text string, lang string, source string, n_chars bigint"),
}
