"""Registration of queries with their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F


class Registry:
    def __init__(self):
        self.QUERIES: dict[str, Callable] = {}
        self.ORACLES: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def register(fn):
            self.QUERIES[name] = fn
            if sql is not None:
                self.ORACLES[name] = sql
            return fn
        return register


def rnd(column: str, digits: int = 6):
    """A rounded column under its own name."""
    return F.round(column, digits).alias(column)
