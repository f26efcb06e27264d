"""Registration of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from driftlens.queries.fx import Fx, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: tuple[str, str]):
    """Register ``f(fx) -> DataFrame`` under ``name``, with the SQL it must equal."""

    def register(build: Callable[[Fx], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Fx(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return build

    return register
