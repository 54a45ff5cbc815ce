"""Positions in a total order, without ever putting the data in one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable, null_safe, small_side

_IN_PARTITION = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def global_rank(df: DataFrame, order: Sequence[Column], group_cols: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based position by ``order`` (within each group if given).

    ``order`` must be total, i.e. end in a unique column; that also lets the range exchange cut inside a
    score or group that holds a large share of the rows. The sorted frame is written once to the shared
    folder together with each row's partition and place; the offsets then come from a table with one row
    per partition (and group).
    """
    groups = list(group_cols)
    placed = durable(
        df.orderBy(*[F.col(g).asc() for g in groups], *order).withColumn("_at", F.monotonically_increasing_id())
    )
    placed = placed.select(
        "*",
        F.shiftright("_at", _IN_PARTITION).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1)).alias("_pos"),
    ).drop("_at")
    runs = placed.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    shifts = runs.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in groups], shift)
    shifts = small_side(durable(shifts))  # one row per partition of the sorted frame (and group): no second shuffle while few
    joined = placed.alias("r").join(
        shifts.alias("s"), null_safe("r", "s", [("_part", "_p")] + [(g, f"_g_{g}") for g in groups])
    )
    return joined.select(*[f"r.{c}" for c in df.columns], (F.col("_pos") + F.col("_shift")).cast("bigint").alias(out))


def ordered(df: DataFrame, *keys: str, desc: bool = False) -> DataFrame:
    """Total order by the keys through a range exchange."""
    return df.orderBy(*[F.col(k).desc() if desc else F.col(k).asc() for k in keys])


def batch_keys(df: DataFrame, key: str, order: Sequence[Column], size: int) -> DataFrame:
    """Keys in order, cut into batches of ``size``: ``batch, batch_name, n, keys``; the last one is short."""
    ranked = global_rank(df, order)
    batch = F.floor((F.col("rank") - 1) / F.lit(size)).cast("bigint")
    return (
        ranked.select(batch.alias("batch"), F.struct(F.col("rank"), F.col(key).alias("key")).alias("item"))
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))  # at most ``size`` items
        .select(
            "batch",
            F.format_string("batch-%09d", "batch").alias("batch_name"),
            F.size("items").cast("bigint").alias("n"),
            F.col("items.key").alias("keys"),
        )
    )
