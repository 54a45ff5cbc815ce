"""The highest rows of each group without sorting all rows: counts in score ranges narrow down where the last one lies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable, null_safe, small_side
from .rank import global_rank

#: Ranges counted in one pass, and rows of a range that are few enough to be sorted.
BINS, EDGE = 1024, 100_000
#: Half the greatest double: differences of two such values stay finite.
_FAR = 8e307


def _finite(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(_FAR)), F.lit(-_FAR))


def _met(df: DataFrame, state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows with the state of their group; a group without state has no wanted row and goes."""
    named = state.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.struct(*[c for c in state.columns if c not in groups]).alias("_state"))
    left, right = df.alias("r"), (small_side(named) if groups else F.broadcast(named)).alias("s")
    on = null_safe("r", "s", [(g, f"_g_{g}") for g in groups]) if groups else F.lit(True)
    return left.join(right, on).select("r.*", "_state")


def narrowed(df: DataFrame, score: str, goals: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per group with a ``k`` above 0 in ``goals``: ``k, lo, hi, n, above, whole``.

    The k-th row in descending order has a score of ``lo`` to ``hi``; ``n`` rows do, and ``above`` rows score more. A
    range is cut into ``BINS`` parts, whose counts, least and greatest scores are merged on the map side, and only the part
    with the k-th row is counted again, until it holds one score or at most ``EDGE`` rows. ``whole`` marks groups that
    have no more than k rows. Scores must not be null or NaN. One pass a round over the rows still in question; a
    round leaves at most one row a group.
    """
    groups = list(group_cols)
    s = F.col(score).cast("double")
    n, low, high = F.count(F.lit(1)).alias("n"), F.min(s).alias("lo"), F.max(s).alias("hi")
    whole = df.groupBy(*groups).agg(n, low, high)
    wanted = goals.where("k > 0")
    on = null_safe("r", "s", [(g, g) for g in groups]) if groups else F.lit(True)
    first = whole.alias("r").join(small_side(durable(wanted)).alias("s"), on)
    zero = F.lit(0).cast("bigint").alias("above")
    state = durable(first.select(*[f"r.{g}" for g in groups], "s.k", "r.lo", "r.hi", "r.n", zero, (F.col("s.k") >= F.col("r.n")).alias("whole")))
    is_open = ~F.col("whole") & (F.col("n") > EDGE) & (F.col("lo") < F.col("hi"))
    while not state.where(is_open).isEmpty():
        rows = _met(df.select(*groups, s.alias("_v")), state.where(is_open), groups)
        v, lo, hi = F.col("_v"), F.col("_state.lo"), F.col("_state.hi")
        share = F.try_divide(_finite(v) - _finite(lo), _finite(hi) - _finite(lo))
        share = F.coalesce(share, (v > lo).cast("int").cast("double"))  # where both ends are too far out to be told apart
        part = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int").alias("_bin")
        counts = (
            rows.where(v.between(lo, hi))
            .groupBy(*groups, part)
            .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.first("_state.k").alias("k"), F.first("_state.above").alias("_was"))
        )
        down = Window.partitionBy(*groups).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)  # BINS rows a group
        placed = counts.withColumn("above", F.col("_was") + F.coalesce(F.sum("n").over(down), F.lit(0)))
        here = placed.where((F.col("above") < F.col("k")) & (F.col("k") <= F.col("above") + F.col("n")))
        state = durable(here.withColumn("whole", F.lit(False)).select(*state.columns).unionByName(state.where(~is_open)))
    return state


def highest(
    df: DataFrame, score: str, tie_break: Sequence[str], goals: DataFrame, group_cols: Sequence[str] = (), with_rank: bool = True
) -> DataFrame:
    """The ``k`` highest rows of each group of ``goals``, by score and then ``tie_break``; with their ``rank`` if asked for.

    Without rank only rows of the range that holds the k-th one are sorted; with it those above it as well. Other rows
    are dropped by a comparison with their group's bound.
    """
    groups = list(group_cols)
    cuts = narrowed(df, score, goals, groups)
    s, of = F.col(score).cast("double"), lambda c: F.col(f"_state.{c}")
    order = [F.col(score).desc(), *[F.col(t).asc() for t in tie_break]]
    near = _met(df, cuts, groups).where(of("whole") | (s >= of("lo")))
    if with_rank:
        ranked = global_rank(near, order, groups)
        return ranked.where(F.col("rank") <= of("k")).select(*df.columns, "rank")
    sure = of("whole") | (s > of("hi"))
    edge = global_rank(near.where(~sure), order, groups, out="_place").where(F.col("_place") <= of("k") - of("above"))
    return near.where(sure).select(*df.columns).unionByName(edge.select(*df.columns))
