"""Fixed, signed and cumulative histograms over whole numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import jround

# Fixed values (the two standard bound sets of a score report)
BOUNDS_500K = (0, 100_000, 200_000, 300_000, 400_000, 500_000)
BOUNDS_3M = (0, 1_000_000, 1_500_000, 2_000_000, 2_500_000, 3_000_000)


def labels(bounds: Sequence[int]) -> list[str]:
    """Names of the ``len(bounds) + 1`` buckets; the closed ends say where a bound itself is counted."""
    out = [f"(-inf, {bounds[0]}]" if bounds[0] <= 0 else f"(-inf, {bounds[0]})"]
    for a, b in zip(bounds, bounds[1:]):
        if b <= 0:
            out.append(f"({a}, {b}]")
        else:
            out.append(f"({a}, {b})" if a <= 0 else f"[{a}, {b})")
    last = bounds[-1]
    out.append(f"({last}, inf)" if last <= 0 else f"[{last}, inf)")
    return out


def bucket_of(col: Column | str, bounds: Sequence[int]) -> Column:
    """Index of the bucket of a whole number.

    Negative numbers go to the first bound at or above them, positive ones to the first bound above them.
    Zero goes to a bound that is exactly zero, else to the overflow.
    """
    v = F.col(col) if isinstance(col, str) else col
    over = len(bounds)
    neg = pos = F.when(F.lit(False), over)
    for i, bound in enumerate(bounds):
        neg, pos = neg.when(v <= bound, i), pos.when(v < bound, i)
    zero = list(bounds).index(0) if 0 in bounds else over
    return F.when(v == 0, zero).when(v < 0, neg.otherwise(over)).when(v > 0, pos.otherwise(over))


def histogram(df: DataFrame, col: str, bounds: Sequence[int], group_cols: Sequence[str] = ()) -> DataFrame:
    """``bucket, label, n`` for every bucket, empty ones included."""
    groups = list(group_cols)
    counted = (
        df.where(F.col(col).isNotNull())
        .select(*groups, jround(col).alias("_v"))
        .groupBy(*groups, bucket_of("_v", bounds).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = F.array(*[F.lit(t) for t in labels(bounds)])
    owners = counted.select(*groups).distinct() if groups else df.sparkSession.range(1)
    empty = owners.select(*groups, F.posexplode(names).alias("bucket", "_l")).select(
        *groups, "bucket", F.lit(0).cast("bigint").alias("n")
    )
    return (
        counted.unionByName(empty)
        .groupBy(*groups, "bucket")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .select(*groups, "bucket", F.get(names, F.col("bucket")).alias("label"), "n")
    )


def histogram_signed(df: DataFrame, col: str, width: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Histogram mirrored around zero: ``side, step, lower, upper, n``.

    Negative buckets run from -1 downwards in steps of ``width``, positive ones from 1 upwards; the
    outermost bucket of a side is open (null bound), zero has a bucket of its own. Empty buckets between
    are listed. Works out how far each side reaches from the counted buckets, not from another scan.
    """
    groups = list(group_cols)
    v = jround(col)
    side = F.when(v < 0, -1).when(v == 0, 0).otherwise(1)
    step = F.when(v == 0, F.lit(0)).otherwise(F.floor((F.abs(v) - 1) / F.lit(width))).cast("bigint")
    counted = (
        df.where(F.col(col).isNotNull())
        .select(*groups, F.col(col).alias("_x"), side.alias("side"), step.alias("step"))
        .groupBy(*groups, "side", "step")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("_x"))).alias("reach"))
    )
    # the last bound of a side comes from the unrounded extreme, as whole numbers toward zero
    reach = F.floor((F.floor(F.max("reach").over(Window.partitionBy(*groups, "side"))) - 1) / F.lit(width))
    last = F.when(F.col("side") == 0, F.lit(0)).otherwise(F.greatest(reach, F.lit(0))).cast("bigint")
    folded = (
        counted.withColumn("last", last)
        .select(*groups, "side", "last", F.least("step", "last").alias("step"), "n")
        .groupBy(*groups, "side", "last", "step")
        .agg(F.sum("n").alias("n"))
    )
    holes = (
        folded.groupBy(*groups, "side", "last")
        .agg(F.lit(0).cast("bigint").alias("n"))
        .select(*groups, "side", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("step"), "n")
    )
    near, far = F.col("step") * width + 1, (F.col("step") + 1) * width + 1
    outer = F.col("step") == F.col("last")
    lower = F.when(F.col("side") == 0, 0).when(F.col("side") == 1, near).when(~outer, -far + 1)
    upper = F.when(F.col("side") == 0, 0).when(F.col("side") == -1, -near).when(~outer, far - 1)
    return (
        folded.unionByName(holes)
        .groupBy(*groups, "side", "last", "step")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .select(
            *groups,
            F.col("side").cast("bigint").alias("side"),
            "step",
            lower.cast("bigint").alias("lower"),
            upper.cast("bigint").alias("upper"),
            "n",
        )
    )


def cumulative_distribution(
    df: DataFrame,
    col: str,
    bounds: Sequence[int],
    complementary: bool = False,
    compat: bool = False,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Values at or below each bound, or above it (``complementary``): ``pos, bound, overflow, n``.

    The complement starts at zero and stops before the last bound. The overflow row counts values above
    the last bound; with ``compat`` it also repeats what the last bound counts and what no bound counts.
    One scan fills the gaps between bounds, the running sums work on those few rows.
    """
    groups = list(group_cols)
    keys = [0, *bounds[:-1]] if complementary else list(bounds)
    last = bounds[-1]
    v = jround(col)
    wanted = [(v > k) if complementary else (v <= k) for k in keys]
    cells = [F.count_if(w) for w in wanted]
    above = F.count_if(v > last)
    if not compat:
        over = above
    else:
        at_last = (v > last) if complementary else (v <= last)
        none = ~(v > last)
        for w in wanted:
            none = none & ~w
        over = F.count_if(at_last) + (F.count_if(none) if complementary else above)
    wide = df.groupBy(*groups).agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)], over.alias("over"))
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("pos"),
            F.lit(k).cast("bigint").alias("bound"),
            F.lit(False).alias("overflow"),
            F.col(f"c{i}").alias("n"),
        )
        for i, k in enumerate(keys)
    ]
    rows.append(
        F.struct(
            F.lit(len(keys)).cast("bigint").alias("pos"),
            F.lit(last).cast("bigint").alias("bound"),
            F.lit(True).alias("overflow"),
            F.col("over").alias("n"),
        )
    )
    return wide.select(*groups, F.inline(F.array(*rows)))


def merge_histograms(first: DataFrame, second: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Add two histograms of the same shape bucket by bucket."""
    keys = [*group_cols, "bucket", "label"]
    return first.unionByName(second).groupBy(*keys).agg(F.sum("n").cast("bigint").alias("n"))
