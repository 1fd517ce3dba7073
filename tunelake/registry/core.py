"""Registration of queries, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunelake.registry.inputs import INPUTS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Add a query; ``uses`` names the derived inputs its SQL reads."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_inputs(sql, uses)
        return fn

    return add


def with_inputs(sql: str, uses: tuple[str, ...]) -> str:
    """Prefix a statement with the derived inputs it reads."""
    ctes = ",\n".join(f"{u} AS ({INPUTS[u].strip()})" for u in uses)
    body = sql.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{ctes},\n{body[len(head):]}" if ctes else body
    return f"WITH {ctes}\n{body}" if ctes else body
