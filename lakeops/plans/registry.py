"""Registry of named queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakeops.plans.binding import Tables
from lakeops.plans.binding_sql import with_binding


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``; ``sql`` may use the binding views."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in ENTRIES:
            raise ValueError(f"query registered twice: {name}")
        ENTRIES[name] = Entry(name, build, with_binding(sql) if sql else None)
        return build

    return add
