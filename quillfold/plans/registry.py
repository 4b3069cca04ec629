"""A registry of named queries and, where SQL says the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return add


class Tables:
    """The driver's tables of a folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
