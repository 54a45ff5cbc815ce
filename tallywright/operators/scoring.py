"""Analysis of scored populations.

Every operator takes ``group_cols``, so a folder of scored files is one scan with the file name as a
group instead of one job per file. Scores are counted after rounding half toward positive infinity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import PROFILE_URL_BY_ID, jround, trunc_to
from ..runtime import durable, rows_of, small_side
from .histogram import BOUNDS_3M, BOUNDS_500K, bucket_of, labels
from .rank import global_rank
from .selection import highest

# Fixed values (two closed negative bands)
NEGATIVE_BANDS = ((-10_000, -5_001), (-15_000, -10_001))


def _moments(score: str) -> list[Column]:
    s = F.col(score)
    return [
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        F.count(s).alias("n"),
        F.sum(s).alias("sum_score"),
        F.avg(s).alias("mean"),
        F.stddev_samp(s).alias("sd"),
        (F.avg(s) + F.stddev_samp(s)).alias("mean_plus_sd"),
    ]


def score_moments(df: DataFrame, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """min, max, count, sum, mean, sample deviation and mean plus deviation in one pass."""
    return df.groupBy(*group_cols).agg(*_moments(score))


def score_signs(df: DataFrame, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Positive, negative and zero counts with their shares: ``sign, n, share`` plus a total."""
    groups = list(group_cols)
    v = jround(score)
    wide = df.groupBy(*groups).agg(
        F.count_if(v > 0).alias("positive"), F.count_if(v < 0).alias("negative"), F.count_if(v == 0).alias("zero")
    )
    wide = wide.withColumn("total", F.col("positive") + F.col("negative") + F.col("zero"))
    names = ("positive", "zero", "negative", "total")
    long = rows_of(wide, "sign", "n", [(s, F.col(s)) for s in names], keep=(*groups, "total"))
    return long.select(*groups, "sign", "n", (F.col("n") / F.nullif("total", F.lit(0))).alias("share"))


def score_bands(
    df: DataFrame, score: str, bands: Sequence[tuple[int, int]] = NEGATIVE_BANDS, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Rounded scores within closed bands: ``low, high, n``."""
    groups = list(group_cols)
    v = jround(score)
    wide = df.groupBy(*groups).agg(*[F.count_if(v.between(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(bands)])
    cells = [
        F.struct(F.lit(a).cast("bigint").alias("low"), F.lit(b).cast("bigint").alias("high"), F.col(f"c{i}").alias("n"))
        for i, (a, b) in enumerate(bands)
    ]
    return wide.select(*groups, F.inline(F.array(*cells)))


def _per_group(df: DataFrame, table: DataFrame, groups: list[str]) -> DataFrame:
    """Columns of a table with one row per group next to each row of that group; the table is made once."""
    right = table.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *[c for c in table.columns if c not in groups])
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    return df.join(small_side(durable(right)), same).drop(*[f"_g_{g}" for g in groups])


def above_mean_plus_sd(df: DataFrame, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows strictly above mean plus sample deviation; the threshold is found beforehand, per group if given."""
    groups = list(group_cols)
    bar = df.groupBy(*groups).agg((F.avg(score) + F.stddev_samp(score)).alias("_bar"))
    if not groups:
        return df.where(F.col(score) > bar.scalar())
    return _per_group(df, bar, groups).where(F.col(score) > F.col("_bar")).drop("_bar")


def rounded_distribution(df: DataFrame, score: str, step: int = 1000, group_cols: Sequence[str] = ()) -> DataFrame:
    """Count by score rounded to whole steps."""
    rounded = (jround(F.col(score) / F.lit(step)) * F.lit(step)).alias("rounded")
    return df.select(*group_cols, rounded).groupBy(*group_cols, "rounded").agg(F.count(F.lit(1)).alias("n"))


def score_bucket(score: str) -> Column:
    """Hundreds of the rounded score, cut toward zero."""
    return trunc_to(jround(score), 100)


def sample_per_group(df: DataFrame, score: str, order: Sequence[Column], k: int = 3, group_cols: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of every score bucket by ``order``, with the bucket as ``rounded_score``.

    The rank limit is applied on the map side before the shuffle, so a bucket that holds a third of all
    rows sends ``k`` rows per task.
    """
    bucketed = df.withColumn("rounded_score", score_bucket(score))
    by = Window.partitionBy(*group_cols, "rounded_score").orderBy(*order)
    return bucketed.withColumn("_rn", F.row_number().over(by)).where(F.col("_rn") <= k).drop("_rn")


def left_enrich(df: DataFrame, ids: DataFrame, key: str, id_col: str, url: str = "profile_url") -> DataFrame:
    """Attach an id to each row where one is known, and the profile address built from it (else null)."""
    joined = df.join(ids.select(key, id_col), key, "left")
    return joined.withColumn(url, F.concat(F.lit(PROFILE_URL_BY_ID), F.col(id_col).cast("string")))


def _chunk_sizes(df: DataFrame, score: str, groups: list[str]) -> DataFrame:
    return df.groupBy(*groups).agg((F.count_if(jround(score) > 0) - F.count_if(jround(score) > 0) % 10).alias("tens"))


def _ranked_with_size(df: DataFrame, score: str, tie_break: Sequence[str], groups: list[str]) -> DataFrame:
    order = [F.col(score).desc(), *[F.col(t).asc() for t in tie_break]]
    ranked = global_rank(df, order, groups)
    size = (F.col("tens") / 10).cast("bigint")
    too_few = F.raise_error(F.lit("fewer than ten positive scores: no decile can be formed")).cast("bigint")
    sizes = _chunk_sizes(df, score, groups).select(*groups, F.when(size == 0, too_few).otherwise(size).alias("chunk"))
    return _per_group(ranked, sizes, groups) if groups else ranked.withColumn("chunk", sizes.scalar())


def chunk_bounds(df: DataFrame, score: str, tie_break: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Decile bounds: all scores in descending order, cut into chunks of a tenth of the positive ones.

    ``chunk, max_score, min_score, n``. There are more than ten chunks when scores at or below zero exist;
    the last chunk may be short.
    """
    groups = list(group_cols)
    keep = df.select(*dict.fromkeys([*groups, score, *tie_break]))
    ranked = _ranked_with_size(keep, score, tie_break, groups)
    at = F.floor((F.col("rank") - 1) / F.col("chunk")).cast("bigint")
    return (
        ranked.select(*groups, at.alias("at"), score)
        .groupBy(*groups, "at")
        .agg(F.max(score).alias("max_score"), F.min(score).alias("min_score"), F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("at", "chunk")
    )


def top_deciles(
    df: DataFrame,
    score: str,
    tie_break: Sequence[str],
    deciles: int | None = None,
    choice: DataFrame | None = None,
    group_cols: Sequence[str] = (),
    with_rank: bool = True,
) -> DataFrame:
    """Rows of the best deciles by score, with their ``rank`` if asked for.

    ``deciles`` applies to all rows; ``choice`` (the group columns and ``deciles``) sets the number per
    group, and a group it does not name is an error, like an unknown job. A row without a score (null or
    not a number) has no rank, whatever the number of deciles. How many rows a group gives is known from its positive
    scores, so ``selection.highest`` finds them without sorting the others.
    """
    groups = list(group_cols)
    number = F.col(score).cast("double")
    df = df.where(number.isNotNull() & ~F.isnan(number))
    size = (F.col("tens") / 10).cast("bigint")
    too_few = F.raise_error(F.lit("fewer than ten positive scores: no decile can be formed")).cast("bigint")
    goals = _chunk_sizes(df, score, groups).withColumn("chunk", F.when(size == 0, too_few).otherwise(size))
    if choice is None:
        wanted = F.lit(deciles)
    else:
        picks = choice.select(*[F.col(g).alias(f"_c_{g}") for g in groups], F.col("deciles").cast("bigint").alias("_d"))
        goals = goals.join(picks, [F.col(g) == F.col(f"_c_{g}") for g in groups], "left")
        missing = F.raise_error(F.lit("no number of deciles chosen for a group")).cast("bigint")
        wanted = F.coalesce(F.col("_d"), missing)
    return highest(df, score, tie_break, goals.select(*groups, (wanted * F.col("chunk")).alias("k")), groups, with_rank)


def analysis_report(df: DataFrame, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The long report as ``pos, metric, value, share`` rows, per group if given.

    Signs, moments and both standard histograms are one aggregate over one scan; the count above mean
    plus deviation needs the threshold first and is the only second scan.
    """
    groups = list(group_cols)
    sets = (("h", BOUNDS_500K), ("m", BOUNDS_3M))
    whole = df.select(*groups, score, jround(score).alias("v"))
    placed = whole.select(*groups, score, "v", *[bucket_of("v", bounds).alias(tag) for tag, bounds in sets])
    signs = (("pos", F.col("v") > 0), ("neg", F.col("v") < 0), ("zer", F.col("v") == 0))
    aggs = [*_moments(score), *[F.count_if(test).alias(name) for name, test in signs]]
    for tag, bounds in sets:
        aggs += [F.count_if(F.col(tag) == i).alias(f"{tag}{i}") for i in range(len(bounds) + 1)]
    one = placed.groupBy(*groups).agg(*aggs).withColumn("total", F.col("pos") + F.col("neg") + F.col("zer"))
    above = above_mean_plus_sd(df.select(*groups, score), score, groups).groupBy(*groups).agg(F.count(F.lit(1)).alias("above"))
    if groups:
        # a group without a row above its threshold still has to appear
        none = one.select(*groups, F.lit(0).cast("bigint").alias("above"))
        wide = _per_group(one, above.unionByName(none).groupBy(*groups).agg(F.sum("above").alias("above")), groups)
    else:
        wide = one.withColumn("above", above.scalar())
    pairs = [
        ("Positive", F.col("pos")),
        ("Zero", F.col("zer")),
        ("Negative", F.col("neg")),
        ("Total", F.col("total")),
        ("Mean", F.col("mean")),
        ("Standard Deviation", F.col("sd")),
        ("Standard Deviation + Mean", F.col("mean_plus_sd")),
        ("Standard Deviation + Mean Count", F.col("above")),
    ]
    for tag, bounds in sets:
        pairs += [(t, F.col(f"{tag}{i}")) for i, t in enumerate(labels(bounds))]
    long = rows_of(wide, "metric", "value", [(n, c.cast("double")) for n, c in pairs], keep=(*groups, "total"))
    share = F.when(F.col("metric").isin("Positive", "Zero", "Negative"), F.col("value") / F.nullif("total", F.lit(0)))
    return long.select(*groups, F.col("_pos").cast("bigint").alias("pos"), "metric", "value", share.alias("share"))
