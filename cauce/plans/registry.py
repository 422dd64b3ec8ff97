"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cauce.session import ship

Query = Callable[[SparkSession, str], DataFrame]


def shipped(f: Query) -> Query:
    """``f``, with the package sent to the workers first."""

    @wraps(f)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return f(spark, folder)

    return run


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries named {name}")
            self.queries[name] = shipped(f)
            if sql is not None:
                self.oracle[name] = sql
            return f

        return add
