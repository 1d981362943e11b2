"""Queries and their SQL, registered by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query, with SQL where SQL can express it."""

        def keep(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep
