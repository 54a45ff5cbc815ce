"""Mixing of sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import global_rank
from ..runtime import durable, small_side
from .common import carried, text_key

#: A source's keys are counted in so many parts; only the part in which its budget ends is sorted.
PARTS = 4096
SPACE = r"\x20\x09-\x0D"


def words_in(text: str = "text") -> Column:
    """Number of maximal runs of other characters than ASCII spaces; null has none."""
    c = F.coalesce(F.col(text), F.lit(""))
    edges = F.when(c.rlike(rf"\A[{SPACE}]"), 1).otherwise(0) + F.when(c.rlike(rf"[{SPACE}]\z"), 1).otherwise(0)
    return F.when(F.length(c) == 0, 0).otherwise(F.size(F.split(c, rf"[{SPACE}]+")) - edges).cast("long")


def quality_weight(text: str = "text") -> Column:
    """Share of characters that are neither symbols nor digits, at least 0.01: what a document's key is scaled by."""
    c = F.coalesce(F.col(text), F.lit(""))
    rest = F.length(F.regexp_replace(c, r"[#*$%&|<>{}\[\]\\^~_=+@0-9]+", ""))
    return F.greatest(F.lit(0.01), F.coalesce(F.try_divide(rest, F.length(c)), F.lit(0.0)))


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, take ``weights`` in turn. Together they get ``share`` of all sizes; none more than
    ``most`` times its own, the excess going to the others by weight. That is one level for all: a target is
    ``min(most * size, level * weight)``. The level rises until no further source is above it; each
    round is one aggregate of the source table, which never leaves Spark.
    """
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], out="place")
    given = F.array(*[F.lit(float(w)) for w in weights])[F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")]
    known = durable(ranked.select("source", "source_size", given.alias("weight")))
    top = most * F.col("source_size")
    level = 0.0
    while True:
        full = top <= level * F.col("weight")
        row = known.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, top)).alias("fixed"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        after = (share * (row["all"] or 0) - (row["fixed"] or 0)) / row["weight"] if row["weight"] else level
        if after <= level:
            break
        level = after
    return known.select("source", "source_size", F.least(top, level * F.col("weight")).cast("double").alias("target"))


def mixed(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with ``size, source_size, target, quality, copies, taken``: how often the mix takes each document.

    A source's target is taken in whole epochs first; what remains of it is drawn without replacement: each document has the
    key -ln(u) / quality (u from a hash of doc_id and text), and those with the smallest keys are taken while the
    prefix sum of sizes comes nearest to the budget. A source's keys are summed in ``PARTS`` parts with map-side
    combine, so only the part in which the budget ends is sorted, and a document is taken by comparing its
    key with its source's last one. Nothing depends on partitioning, so reruns agree.

    A null text has size 0 and is taken 0 words of; sources of size 0 have target 0. A null source is a source. Rows that repeat
    doc_id and text have one key and are drawn together. Columns of those names in ``docs`` are replaced.
    """
    docs, own = carried(docs, ["doc_id", "text", "source"], ["size", "source_size", "target", "quality", "copies", "taken"])
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", text_key()), 11) + F.lit(1)) / F.lit(float((1 << 53) + 1))
    keyed = docs.withColumns({"size": words_in(), "quality": quality_weight()})
    keyed = keyed.withColumn("_key", F.struct((-F.log(unit) / F.col("quality")).alias("e"), F.col("doc_id").alias("d"), text_key().alias("k")))
    part = F.floor((1 - F.exp(-F.col("_key.e"))) * PARTS).cast("int")
    rows = durable(keyed.where("size > 0").select("source", "size", "_key", part.alias("part")))
    sums = durable(rows.groupBy("source", "part").agg(F.sum("size").alias("size")))
    empty = keyed.where("size = 0").select("source", F.lit(0).cast("long").alias("size"))
    sources = sums.select("source", "size").union(empty).groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = durable(targets(durable(sources), weights, share, most))

    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") + 1e-12).otherwise(0.0))
    budget = goal.select(F.col("source").alias("s"), whole.cast("int").alias("epochs"), (F.col("target") - whole * F.col("source_size")).alias("budget"))
    same = F.col("source").eqNullSafe(F.col("s"))
    until = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        sums.withColumn("sum", F.sum("size").over(until))
        .join(budget, same)
        .where((F.col("sum") - F.col("size") <= F.col("budget")) & (F.col("budget") < F.col("sum")))
        .select("s", F.col("part").alias("last_part"), (F.col("budget") - F.col("sum") + F.col("size")).alias("room"))
    )
    ends = durable(ends)
    inner = rows.join(small_side(ends), same & (F.col("part") == F.col("last_part")))
    units = inner.groupBy("s", "_key", "room").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("s").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = units.withColumn("sum", F.sum("size").over(before)).where(F.col("sum") - F.col("size") / 2 <= F.col("room"))
    cut = near.groupBy("s").agg(F.max("_key").alias("cut"))
    plan = goal.join(budget.select("s", "epochs"), same).drop("s").join(ends.select("s", "last_part"), same, "left").drop("s")
    plan = plan.join(cut, same, "left").drop("s")
    names = {"source": "_s", "source_size": "source_size", "target": "target", "epochs": "_epochs", "last_part": "_last", "cut": "_cut"}
    plan = durable(plan.select(*[F.col(a).alias(b) for a, b in names.items()]))

    keyed = keyed.withColumn("_part", part)
    more = (F.col("_part") < F.col("_last")) | (F.col("_part") == F.col("_last")) & (F.col("_key") <= F.col("_cut"))
    copies = F.when(F.col("size") > 0, F.col("_epochs") + F.coalesce(more.cast("int"), F.lit(0))).otherwise(0)
    joined = keyed.join(small_side(plan), F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", copies.cast("int"))
    return joined.select(*own, "size", "source_size", "target", "quality", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
