"""Where a query is registered together with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evstream import schemas
from evstream.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one folder, read with their declared schemas."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in schemas.TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(schemas.TABLES[name]).parquet(path)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and, where there is one, its SQL twin."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(prepare(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
