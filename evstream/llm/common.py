"""What the operators of this subpackage share: tables, saved stages, connected components."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from evstream.session import prepare, scratch_path

# Rows and bytes handed to a Python worker at once: bounds memory when texts are long.
ARROW_ROWS, ARROW_BYTES = "1000", str(16 << 20)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` and, where there is one, its SQL twin."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(ready(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a stage into the shared folder and read it back: it survives lost executors, is
    computed once, and later plans start from files."""
    path = scratch_path(ready(df.sparkSession), name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grows(df: DataFrame) -> DataFrame:
    """The side of a join whose size follows the input: dealt by key at every size, never sent
    whole to all tasks."""
    return df.hint("merge")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names an operator is about to give out itself (in any case)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (its smallest reachable node) of every node that has an edge.

    Alternates large-star and small-star steps. Each step is a grouped minimum, summed up in
    every task before its shuffle, and an equi-join whose hot nodes AQE can split; the edge list
    never grows, and steps are saved. Nodes may be longs or any orderable type; NULL ends and
    loops are left out.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, last = saved(e, "edges"), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last or now[0] == 0:
            break
        last = now
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        hop = small.select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("s")).select("s.u", "s.v")
        e = saved(hop.where("u <> v").distinct(), "edges")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select("v", "v")).distinct()
