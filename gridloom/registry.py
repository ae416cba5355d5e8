"""Queries and their DuckDB SQL, collected by name as modules declare them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Holds queries in the order of their declaration."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        """Registers the decorated function, with its SQL where there is one."""

        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = f
            if oracle is not None:
                self.oracles[name] = oracle
            return f

        return add
