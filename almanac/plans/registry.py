"""Queries register themselves here with, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import duck

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``views`` are put in front of its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            text = sql.strip()
            if views:
                heads = ", ".join(map(duck, views))
                lead = next((w for w in ("WITH RECURSIVE ", "WITH ") if text.startswith(w)), None)
                text = f"{lead}{heads}, {text.removeprefix(lead)}" if lead else f"WITH {heads} {text}"
            ORACLES[f.__name__] = text
        return f

    return add
