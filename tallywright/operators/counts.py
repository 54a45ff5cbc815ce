"""Plain counts, sets and sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import counter_json


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def counter_report(df: DataFrame, counters: Sequence[tuple[str, Column]]) -> DataFrame:
    """Named aggregates of one pass as a JSON object in column ``report``."""
    wide = df.agg(*[c.cast("bigint").alias(f"c{i}") for i, (_, c) in enumerate(counters)])
    return wide.select(counter_json([(n, F.col(f"c{i}")) for i, (n, _) in enumerate(counters)]).alias("report"))


def distinct_set(df: DataFrame, col: str) -> DataFrame:
    """The set of values of a column, one row each (it may not fit one array)."""
    return df.select(col).distinct()


def exact_sum(df: DataFrame, col: str, scale: int = 2, group_cols: Sequence[str] = ()) -> DataFrame:
    """Sum without floating-point error."""
    return df.groupBy(*group_cols).agg(F.sum(F.col(col).cast(f"decimal(28,{scale})")).alias("total"))
