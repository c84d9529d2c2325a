"""Named queries with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .view_sql import with_views
from .views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    """Register a function of the views; ``sql`` may name the views as ``v_...``."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
