"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from carelake.catalog.bindings import VIEWS, Tables

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str) -> str:
    """SQL with the domain views it mentions as leading CTEs."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name, definition in VIEWS.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(definition)
                used.append(name)

    visit(body)
    if not used:
        return body
    recursive = "RECURSIVE " if re.match(r"\s*WITH\s+RECURSIVE\b", body) else ""
    body = re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", "", body)
    is_chain = bool(re.match(r"[\w]+\s*(\([^)]*\))?\s+AS\s*(MATERIALIZED\s*)?\(", body))
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in used)
    return f"WITH {recursive}{views}{', ' if is_chain else ' '}{body}"


def query(name: str, sql: str | None = None):
    """Register a function `Tables -> DataFrame` under `name`."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
