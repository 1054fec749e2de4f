"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankweave.catalog.shape import shape
from rankweave.catalog.sqltext import select
from rankweave.plans.workbench import Workbench

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, columns: str, sql: str | None = None, *ctes: str, extra=None):
    """Register a function from a workbench to a DataFrame, its result columns and its SQL form."""

    def add(function: Callable[[Workbench], DataFrame]):
        QUERIES[name] = lambda spark, folder: shape(function(Workbench.of(spark, folder)), columns)
        if sql is not None:
            SQL[name] = select(columns, sql, *ctes, extra=extra)
        return function

    return add
