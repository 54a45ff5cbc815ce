"""Linking two mappings: common keys, one best partner per key, scores of the partner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_keys(a: DataFrame, b: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Distinct key tuples both sides hold, under the names of the left side; null keys never match.

    Both sides are reduced to distinct keys, tagged and merged: one shuffle, no join, and a key that
    fills a third of a side arrives as one row per task.
    """
    names = [x for x, _ in on]
    left = a.select(*names, F.lit(1).alias("_side"))
    right = b.select(*[F.col(y).alias(x) for x, y in on], F.lit(2).alias("_side"))
    return (
        left.unionByName(right)
        .dropna(subset=names)
        .groupBy(*names)
        .agg(F.bit_or("_side").alias("_sides"))
        .where(F.col("_sides") == 3)
        .select(*names)
    )


def population_counts(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values (or pairs) of several column sets in one pass; a null counts as a value.

    Returns ``what, n``.
    """
    wide = df.agg(*[F.count_distinct(F.struct(*cols)).alias(name) for name, cols in sets.items()])
    return wide.unpivot([], list(sets), "what", "n")


def argmin_struct(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The row with the least ``cols`` (compared left to right) of each group."""
    best = df.groupBy(*group).agg(F.min(F.struct(*cols)).alias("_best"))
    return best.select(*group, *[F.col(f"_best.{c}").alias(c) for c in cols])


def crosswalk_best(
    a: DataFrame, b: DataFrame, on: Sequence[tuple[str, str]], link: str, partner: str, carry: Sequence[str] = ()
) -> DataFrame:
    """One partner per link key: the least ``(partner, carry...)`` among rows that agree on both ids.

    For the least partner only the least one per id pair can win, so the right side is reduced to that
    before the join: a pair held by a third of the rows on both sides meets as m rows x 1, never m x n.
    """
    left_names = [x for x, _ in on]
    left = a.select(link, *dict.fromkeys([*left_names, *carry])).distinct()
    right = b.groupBy(*[F.col(y).alias(f"_k{i}") for i, (_, y) in enumerate(on)]).agg(F.min(partner).alias(partner))
    same = [F.col(x) == F.col(f"_k{i}") for i, x in enumerate(left_names)]
    return argmin_struct(left.join(right, same), [link], [partner, *carry])


def attach_scores(best: DataFrame, scored: DataFrame, partner: str, cols: Sequence[str]) -> DataFrame:
    """Join the best-match table to the scored rows of the partner and keep distinct ``cols``."""
    kept = [c for c in scored.columns if c == partner or c in cols]
    right = scored.select(*kept).distinct()
    left = best.select(*[c for c in best.columns if c == partner or c in cols])
    return left.join(right, partner).select(*cols).distinct()
