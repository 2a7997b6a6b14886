"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathom.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    """Collects (query, SQL) pairs of a module."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def register(f):
            key = name or f.__name__
            self.queries[key] = f
            if sql is not None:
                self.sql[key] = sql
            return f

        return register
