"""Collects (name, operator id, query, SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.plans.fixtures import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def with_views(sql: str, *views: str) -> str:
    if not views:
        return sql
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" + sql


def query(operator: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query under its function name. SQL that starts with a comma adds its own CTEs."""

    def add(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        OPERATORS[name] = operator
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
