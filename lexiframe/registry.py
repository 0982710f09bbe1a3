"""Named queries: a DataFrame builder and, where SQL can say the same, its statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    motive: str


class Registry:
    """Queries by name, in the order they were added."""

    def __init__(self) -> None:
        self._queries: dict[str, Query] = {}

    def query(self, name: str, motive: str, sql: str | None = None) -> Callable[[Builder], Builder]:
        """Decorator that registers a builder; a name can be used once."""

        def add(build: Builder) -> Builder:
            if name in self._queries:
                raise ValueError(f"query {name} is registered twice")
            self._queries[name] = Query(name, build, sql, motive)
            return build

        return add

    def builders(self) -> dict[str, Builder]:
        return {q.name: q.build for q in self._queries.values()}

    def statements(self) -> dict[str, str]:
        return {q.name: q.sql for q in self._queries.values() if q.sql is not None}

    def __iter__(self):
        return iter(self._queries.values())
