"""Registry of queries: a Spark callable and, where SQL can say it, an independent statement of the rule."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..runtime import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def shipped(fn: Query) -> Query:
    """``fn`` that first sees to it that executors have the package."""

    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(ship(spark), folder)

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = shipped(fn)
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (  # noqa: F401
        append_plans,
        audience_plans,
        cell_plans,
        crosswalk_plans,
        drift_plans,
        expr_plans,
        filter_plans,
        match_plans,
        overlap_plans,
        profile_plans,
        score_plans,
        store_plans,
        stream_plans,
    )
