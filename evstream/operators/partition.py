"""Control over how rows are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Even out partitions, round robin."""
    return df.repartition(n)


def widened(df: DataFrame) -> DataFrame:
    """Spread a table that is read in fewer parts than there are cores, before costly row-wise
    work. A table of many parts, as any large one, is left alone, and so are results of other
    work, whose parts cannot be counted without running it."""
    if df.isStreaming or not _bare_scan(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _bare_scan(df: DataFrame) -> bool:
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.children().isEmpty()


def shuffle_random(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Spread rows at random, the same way on every recomputation."""
    return df.repartition(n, F.rand(seed))


def to_first(df: DataFrame) -> DataFrame:
    """All rows in one partition. For results of bounded size only."""
    return df.coalesce(1)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions by merging neighbours, without a shuffle."""
    return df.coalesce(n)


def forward(df: DataFrame) -> DataFrame:
    """One to one: partitions stay as they are."""
    return df


def replicate(df: DataFrame, n: int, copy: str = "copy") -> DataFrame:
    """Every row to each of ``n`` partitions. Meant for rules and lookups; to join against a
    small table use a join and let Spark broadcast it."""
    copies = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col(copy))


def partition_by(df: DataFrame, n: int, number: Column) -> DataFrame:
    """Rows to the partition whose number the expression gives."""
    return df.repartitionById(n, number.cast("int"))


def key_by(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("cnt"))
