"""Named queries over the given tables, with the SQL that states their result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self, queries: dict[str, Query] | None = None, sql: dict[str, str] | None = None) -> None:
        self.queries: dict[str, Query] = dict(queries or {})
        self.sql: dict[str, str] = dict(sql or {})

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return keep
