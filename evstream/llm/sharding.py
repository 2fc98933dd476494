"""Sharding by a hierarchical weighted hash tree, in DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from evstream.llm.common import query, saved, table, without

# Shards of the first tree: regions of two racks of two shards.
RACK, REGION = 2, 4
BASE = 8


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int) -> list[Leaf]:
    """Two shards to a rack and two racks to a region; every shard past the eighth brings a rack
    and a region of its own, so that it takes rows only into itself."""
    return [
        Leaf(s // REGION, s // RACK, s) if s < BASE
        else Leaf(BASE // REGION + s - BASE, BASE // RACK + s - BASE, s)
        for s in range(shards)
    ]


def grown(leaves: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard. No weight of an older subtree changes."""
    top = [max(x) + 1 for x in zip(*[(n.region, n.rack, n.shard) for n in leaves], strict=True)]
    return [*leaves, Leaf(*top, weight)]


def draw(key: Column, level: str, node: int, weight: float) -> Column:
    """Waiting time of a node for a key: exponential at the node's weight, so the node with the
    least draw is chosen in proportion to weight, and a draw changes only with its own weight."""
    bits = F.substring(F.md5(F.concat(key, F.lit(f":{level}:{node}"))), 1, 13)
    uniform = (F.conv(bits, 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.lit(float(weight))


def choice(key: Column, level: str, nodes: dict[int, float]) -> Column:
    draws = [F.struct(draw(key, level, n, w).alias("d"), F.lit(n).alias("n")) for n, w in sorted(nodes.items())]
    return F.array_min(F.array(*draws))["n"]


def _weights(leaves: Sequence[Leaf], level: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for n in leaves:
        out[getattr(n, level)] = out.get(getattr(n, level), 0.0) + n.weight
    return out


def place(df: DataFrame, key: str, leaves: Sequence[Leaf], into: str = "shard") -> DataFrame:
    """Descend region, rack and shard; adds the column ``into``.

    Work per row follows the fan-out of the three levels, not the number of shards. A row changes
    its region only by moving to or from one whose weight changed, and its rack or shard only
    below such a node. Equal keys go together; a NULL key counts as a value of its own.
    """
    at = F.coalesce(F.col(key).cast("string"), F.lit("null"))

    def below(level: str, parent: str, column: str) -> Column:
        cases = [
            (F.col(column) == p, choice(at, level, _weights([n for n in leaves if getattr(n, parent) == p], level)))
            for p in sorted({getattr(n, parent) for n in leaves})
        ]
        return reduce(lambda out, c: out.when(*c), cases[1:], F.when(*cases[0]))

    df = df.withColumn("_region", choice(at, "region", _weights(leaves, "region")))
    df = df.withColumn("_rack", below("rack", "region", "_region"))
    return df.withColumn(into, below("shard", "rack", "_rack")).drop("_region", "_rack")


def slots(df: DataFrame, shard: str = "shard", order: str = "doc_id", into: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without gaps, in order of ``order``.

    Rows are dealt by ranges of ``order``, those of one value by their place in the input, so that a
    value with many rows is cut as well, and numbered within (range, shard); a table with a row
    for each range and shard adds what stands before, so no shard is sorted in one task. Equal
    rows get different numbers, in any order among themselves; NULLs come first.
    """
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(order, "_row")
    dealt = saved(dealt.withColumn("_range", F.spark_partition_id()).drop("_row"), "ranges")
    counts = dealt.groupBy("_range", shard).agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_range", shard, F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range", shard).orderBy(F.col(order).asc_nulls_first()))
    return (dealt.withColumn("_inside", inside).join(before, ["_range", shard])
            .withColumn(into, F.col("_before") + F.col("_inside") - 1)
            .drop("_range", "_before", "_inside"))


def shard_documents(docs: DataFrame, shards: int = BASE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The law is ``key``: id and shard count decide, and one more shard takes rows only into itself.
    Repeated ids share a shard and get a slot each; a NULL text has size 1 and the CRC of nothing;
    an empty table gives an empty one. Other columns of ``docs`` are not carried.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = without(docs, "shard", "grown_shard").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    leaves = tree(shards)
    rows = place(place(rows, "doc_id", leaves), "doc_id", grown(leaves), "grown_shard")
    return slots(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _sql_choice(level: str, nodes: dict[int, float]) -> str:
    draws = ", ".join(
        "{'d': -ln((('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':%s:%d'), 1, 13))::bigint::double"
        " + 0.5) / 4503599627370496.0) / %r, 'n': %d}" % (level, n, float(w), n)
        for n, w in sorted(nodes.items()))
    return f"list_min([{draws}]).n"


def _sql_place(source: str, leaves: Sequence[Leaf], into: str) -> str:
    def below(level, parent):
        whens = " ".join(
            f"when {p} then " + _sql_choice(level, _weights([n for n in leaves if getattr(n, parent) == p], level))
            for p in sorted({getattr(n, parent) for n in leaves}))
        return f"case {parent} {whens} end"

    return (f"select * exclude (region, rack), {below('shard', 'rack')} as {into} from ("
            f"select *, {below('rack', 'region')} as rack from ("
            f"select *, {_sql_choice('region', _weights(leaves, 'region'))} as region from {source}))")


# DuckDB has no CRC-32: the bytes of the text run through a table made by rule.
SQL = f"""
with t as (select range as i, list_reduce(list_prepend(range::bigint, range(8)::bigint[]),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256)),
crc as (select list(v order by i) as tab from t),
s as ({_sql_place("documents", tree(BASE), "shard")}),
g as ({_sql_place("s", grown(tree(BASE)), "grown_shard")})
select doc_id, strlen(coalesce(text, '')) + 1 as size,
  xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(0, strlen(coalesce(text, ''))), lambda k: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * k::int + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32,
  'key' as law, shard, row_number() over (partition by shard order by doc_id) - 1 as slot, grown_shard
from g, crc
"""


@query("op9_sharding", SQL)
def op9_sharding(spark, folder):
    return shard_documents(table(spark, folder, "documents"))
