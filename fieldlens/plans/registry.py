"""Query registry: a name, the operator ids it covers, the Spark plan and, where SQL can
say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, tuple(covers.split()), fn, sql)
        return fn

    return wrap
