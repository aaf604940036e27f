"""Registry of named queries: a Spark callable and, where SQL can say it, the same query as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from worklode.plans.feed import Tables, with_feed


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``covers`` lists the operator ids it exercises."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), fn, with_feed(sql) if sql else None)
        return fn

    return add


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.run(Tables(spark, sf_dir))

    return {name: bind(q) for name, q in REGISTRY.items()}


def sql_texts() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
