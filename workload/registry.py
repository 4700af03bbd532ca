"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str


class Registry(dict[str, Query]):
    def add(self, sql: str) -> Callable[[Run], Run]:
        """Decorator: registers a function under its own name together with its SQL."""

        def register(run: Run) -> Run:
            self[run.__name__] = Query(run, sql)
            return run

        return register
