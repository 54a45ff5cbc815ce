"""Audience labels, tags and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import PROFILE_URL_PREFIX
from ..runtime import durable, small_side
from ..sources.keyed import KeyedTable


def map_codes(rows: DataFrame, codes: DataFrame, key: str = "id", on_missing: str = "raise") -> DataFrame:
    """``id, code`` rows to ``id, label`` rows through a ``code, label`` table.

    An unknown code raises, or is dropped with ``on_missing='drop'``.
    """
    table = codes.where("code IS NOT NULL").groupBy("code").agg(F.max("label").alias("label"))
    joined = rows.select(key, "code").join(small_side(durable(table)), "code", "left" if on_missing == "raise" else "inner")
    label = F.col("label")
    if on_missing == "raise":
        label = F.coalesce(label, F.raise_error(F.concat(F.lit("unknown code "), F.coalesce(F.col("code").cast("string"), F.lit("null")))).cast("string"))
    return joined.select(key, label.alias("label"))


def map_code_lists(rows: DataFrame, codes: DataFrame, key: str = "id", on_missing: str = "raise") -> DataFrame:
    """The same for ``id, codes`` rows with an array of codes: each row keeps its array, as sorted ``labels``.

    Every distinct array is mapped once through the join of its codes. A null array stays null, an empty one empty; a
    null code in an array is an unknown one, a null code in the table is ignored.
    """
    lists = rows.select("codes").distinct()
    flat = lists.select(F.col("codes").alias("_codes"), F.explode("codes").alias("code"))
    mapped = map_codes(flat, codes, "_codes", on_missing)
    labelled = mapped.groupBy("_codes").agg(F.array_sort(F.collect_list("label")).alias("labels"))
    joined = rows.join(labelled, F.col("codes") == F.col("_codes"), "left")
    found = F.coalesce("labels", F.array().cast("array<string>"))
    return joined.select(key, F.when(F.col("codes").isNotNull(), found).alias("labels"))


def merge_audiences(
    stored: DataFrame, incoming: DataFrame, codes: DataFrame, key: str = "id", stored_are_codes: bool = False
) -> DataFrame:
    """Stored and incoming labels of every incoming id, without duplicates: ``id, labels``.

    ``incoming`` holds ``id, code`` rows; ``stored`` holds ``id, label`` rows (codes with
    ``stored_are_codes``). Ids only the store knows are not returned, as nothing about them changes. One
    shuffle over both sides; a label list is bounded by the number of labels.
    """
    fresh = map_codes(incoming, codes, key).withColumn("_new", F.lit(True))
    kept = map_codes(stored.select(key, F.col("label").alias("code")), codes, key) if stored_are_codes else stored
    old = kept.select(key, "label").withColumn("_new", F.lit(False))
    merged = fresh.unionByName(old).groupBy(key).agg(
        F.bool_or("_new").alias("_new"), F.array_sort(F.collect_set("label")).alias("labels")
    )
    return merged.where(F.col("_new")).select(key, "labels")


def store_merged(table: KeyedTable, incoming: DataFrame, codes: DataFrame) -> DataFrame:
    """Merge incoming labels into a stored table of ``id, labels`` and give the rows written.

    Only stored ids that are also incoming are looked up; all other ids stay as they are. A second run adds nothing.
    """
    stored = table.of(incoming).select(table.key, F.explode("labels").alias("label"))
    merged = durable(merge_audiences(stored, incoming, codes, table.key))
    table.upsert(merged)
    return merged


def store_tag(table: KeyedTable, ids: DataFrame, tag: str, tags: str = "tags") -> None:
    """Add a tag to the stored rows of the named ids; ids without a row, and all other rows, stay as they are."""
    table.upsert(add_tag(table.of(ids), ids, tag, table.key, tags))


def merge_counts(merged: DataFrame) -> DataFrame:
    """Records written and labels on them."""
    return merged.agg(
        F.count(F.lit(1)).alias("total_records"), F.coalesce(F.sum(F.size("labels")), F.lit(0)).cast("bigint").alias("total_labels")
    )


def add_tag(df: DataFrame, ids: DataFrame, tag: str, key: str = "id", tags: str = "tags") -> DataFrame:
    """Add a tag to the tag sets of the named rows; other rows stay as they are."""
    chosen = ids.select(F.col(key).alias("_id")).distinct()
    joined = df.join(chosen, F.col(key) == F.col("_id"), "left")
    extended = F.array_union(F.coalesce(F.col(tags), F.array().cast("array<string>")), F.array(F.lit(tag)))
    return joined.withColumn(tags, F.when(F.col("_id").isNotNull(), extended).otherwise(F.col(tags))).drop("_id")


def edge_tombstones(pairs: DataFrame, src: str = "src", tgt: str = "tgt", prefix: str = PROFILE_URL_PREFIX) -> DataFrame:
    """The five stored cells of an edge: both orientations by handle, and three link copies by address."""
    s, t = F.col(src).cast("string"), F.col(tgt).cast("string")
    su, tu = F.concat(F.lit(prefix), s), F.concat(F.lit(prefix), t)
    # fixed values: store, own side, direction, other side
    cells = (
        ("graph", s, "Out", t),
        ("graph", t, "In", s),
        ("links", su, "e_Out", tu),
        ("links", tu, "e_In", su),
        ("links", tu, "eNew_In", su),
    )
    as_structs = [
        F.struct(F.lit(store).alias("store"), own.alias("node"), F.lit(d).alias("direction"), other.alias("other"))
        for store, own, d, other in cells
    ]
    return pairs.select(src, tgt).distinct().select(F.inline(F.array(*as_structs)))


def mark_edges(edges: DataFrame, pairs: DataFrame, **names: str) -> DataFrame:
    """Stored cells with a flag ``dropped`` for those of the given edges, from one join."""
    on = ["store", "node", "direction", "other"]
    dead = edge_tombstones(pairs, **names).withColumn("dropped", F.lit(True))
    return edges.join(dead, on, "left").withColumn("dropped", F.coalesce("dropped", F.lit(False)))


def drop_edges(edges: DataFrame, pairs: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """Stored cells without the given edges, and the cells to delete that do exist."""
    marked = mark_edges(edges, pairs, **names)
    return marked.where(~F.col("dropped")).drop("dropped"), marked.where("dropped").drop("dropped")
