"""Named queries over the star-schema tables, each with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def register(build: Build) -> Build:
        QUERIES[name or build.__name__] = Query(build, sql)
        return build

    return register
