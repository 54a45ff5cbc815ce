"""How much do lists share, and what does each rung of a ladder add?

Every report comes from one small table: the number of values per exact combination of lists. It is
built with a single shuffle on the value, with map-side merging, so a value that fills a third of a
list collapses before it travels. No list is ever joined to another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import pct_of
from ..runtime import compute_once, durable, small_side
from .rank import global_rank
from .rules import drop_blank_normalised

#: Lists that fit the bits of one long; more take several longs, merged on the map side as well.
MASK_LISTS = 63


def _names(lists: DataFrame, col: str, given: Sequence[str] | None) -> list[str] | None:
    """Names in order; at most ``MASK_LISTS + 1`` reach the driver. None means "too many for a mask"."""
    if given is not None:
        return list(given) if len(given) <= MASK_LISTS else None
    found = sorted(r[0] for r in lists.where(F.col(col).isNotNull()).select(col).distinct().limit(MASK_LISTS + 1).collect())
    return found if len(found) <= MASK_LISTS else None


def _bit(col: str, names: Sequence[str]) -> Column:
    bits = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for i, n in enumerate(names):
        bits = bits.when(F.col(col) == n, F.lit(1 << i).cast("bigint"))
    return bits.otherwise(F.lit(0).cast("bigint"))


def _unpack(mask: Column, names: Sequence[str]) -> Column:
    if not names:
        return F.array().cast("array<string>")
    return F.array_compact(
        F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(n)) for i, n in enumerate(names)])
    )


def _asked(lists: DataFrame, col: str, given: Sequence[str] | None) -> DataFrame:
    """Rows of the lists asked for, with a value. A list without a name is none; with names given others are ignored."""
    named = lists.select(col, "value").where(F.col(col).isNotNull() if given is None else F.col(col).isin(list(given)))
    return drop_blank_normalised(named, "value")


def _places(lists: DataFrame, col: str, given: Sequence[str] | None) -> tuple[DataFrame, Column, int]:
    """Lists with their numbers (``name, at``, in the order given or by name), all names as one array, and how many there are."""
    if given is not None:
        names = F.array(*[F.lit(n) for n in dict.fromkeys(given)])
        return lists.sparkSession.range(1).select(F.posexplode(names).alias("at", "name")), names, len(set(given))
    found = lists.where(F.col(col).isNotNull()).select(F.col(col).alias("name")).distinct()
    places = durable(global_rank(found, [F.asc("name")], out="at").select("name", (F.col("at") - 1).alias("at")))
    pairs = F.array_sort(F.collect_list(F.struct("at", "name")))
    return places, places.agg(F.transform(pairs, lambda p: p["name"]).alias("names")).scalar(), places.count()


def _words(rows: DataFrame, col: str, places: DataFrame, names: Sequence[str]) -> DataFrame:
    """``value`` and the bit of its row's list in one of the longs ``names``, 0 in the others."""
    bit = F.expr(f"shiftleft(1L, cast(at % {MASK_LISTS} AS int))")
    word = F.floor(F.col("at") / MASK_LISTS)
    numbered = rows.join(small_side(places), F.col(col) == F.col("name"))
    return numbered.select("value", *[F.when(word == k, bit).otherwise(F.lit(0).cast("bigint")).alias(n) for k, n in enumerate(names)])


def _word_names(prefix: str, lists: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(max(1, -(-lists // MASK_LISTS)))]


def _set_of(words: Sequence[str], names: Column) -> Column:
    """The names whose bits are set, in order."""
    longs = F.array(*[F.col(w) for w in words])
    long = lambda i: F.element_at(longs, (F.floor(i / MASK_LISTS) + 1).cast("int"))
    held = lambda i: F.call_function("shiftright", long(i), (i % MASK_LISTS).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return F.array_compact(F.transform(names, lambda n, i: F.when(held(i), n)))


def combinations(lists: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``(list_name, value)`` rows to ``(members array, n)``: values per exact set of lists."""
    clean = _asked(lists, "list_name", names)
    known = _names(lists, "list_name", names)
    if known is not None:
        masks = clean.groupBy("value").agg(F.bit_or(_bit("list_name", known)).alias("mask"))
        counted = masks.groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
        return compute_once(counted, _unpack(F.col("mask"), known).alias("members"), "n")
    places, named, many = _places(lists, "list_name", names)
    words = _word_names("m", many)
    masks = _words(clean, "list_name", places, words).groupBy("value").agg(*[F.bit_or(w).alias(w) for w in words])
    counted = masks.groupBy(*words).agg(F.count(F.lit(1)).alias("n"))
    counted = compute_once(counted, *words, named.alias("names"), "n")
    return compute_once(counted, _set_of(words, F.col("names")).alias("members"), "n")


def _name_rows(lists: DataFrame, col: str, names: Sequence[str] | None, out: str) -> DataFrame:
    """One row per list, also for a list without values when names are given."""
    if names is not None:
        spark = lists.sparkSession
        return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(out))
    return lists.where(F.col(col).isNotNull()).select(F.col(col).alias(out)).distinct()


def overlap_counts(lists: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """N x N matrix in long form: ``list_a, list_b, n_common``; the diagonal is the distinct size."""
    names = names if names is not None else _names(lists, "list_name", None)
    pairs = (
        combinations(lists, names)
        .select("members", "n", F.explode("members").alias("list_a"))
        .select("list_a", F.explode("members").alias("list_b"), "n")
    )
    rows = _name_rows(lists, "list_name", names, "list_a")
    cols = _name_rows(lists, "list_name", names, "list_b").agg(F.collect_set("list_b").alias("all_b"))
    grid = rows.select("list_a", F.lit(0).cast("bigint").alias("n"))
    if names is not None:
        grid = grid.select("list_a", F.explode(F.array(*[F.lit(n) for n in names])).alias("list_b"), "n")
    else:
        grid = grid.select("list_a", F.explode(cols.scalar()).alias("list_b"), "n")
    # adding the empty grid to the counts fills the zero cells without a join
    return (
        pairs.unionByName(grid)
        .groupBy("list_a", "list_b")
        .agg(F.sum("n").cast("bigint").alias("n_common"))
    )


def overlap_percent(lists: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Each row of the matrix in percent of the row's own size (null for an empty list)."""
    own = Window.partitionBy("list_a")
    size = F.max(F.when(F.col("list_a") == F.col("list_b"), F.col("n_common"))).over(own)
    return (
        overlap_counts(lists, names)
        .withColumn("size", size)
        .select("list_a", "size", "list_b", pct_of("n_common", "size").alias("pct"))
    )


def coverage(
    base: DataFrame,
    ladder: DataFrame,
    base_names: Sequence[str] | None = None,
    rungs: Sequence[str] | None = None,
) -> DataFrame:
    """Values per exact (set of base lists, set of rungs): ``base_set, rung_set, n``.

    ``base`` has ``base_name, value``; ``ladder`` has ``rung_name, value``. ``rungs`` gives the order of the
    ladder (alphabetical when omitted); ``rung_set`` keeps that order.
    """
    known_base = _names(base, "base_name", base_names)
    known_rungs = _names(ladder, "rung_name", rungs)
    b, r = _asked(base, "base_name", base_names), _asked(ladder, "rung_name", rungs)
    if known_base is not None and known_rungs is not None:
        zero = F.lit(0).cast("bigint")
        both = b.select("value", _bit("base_name", known_base).alias("b"), zero.alias("r")).unionByName(
            r.select("value", zero.alias("b"), _bit("rung_name", known_rungs).alias("r"))
        )
        per_value = both.groupBy("value").agg(F.bit_or("b").alias("b"), F.bit_or("r").alias("r"))
        counted = per_value.groupBy("b", "r").agg(F.count(F.lit(1)).alias("n"))
        base_set, rung_set = _unpack(F.col("b"), known_base), _unpack(F.col("r"), known_rungs)
        return compute_once(counted, base_set.alias("base_set"), rung_set.alias("rung_set"), "n")
    base_places, base_named, many = _places(base, "base_name", base_names)
    of_base = _word_names("b", many)
    rung_places, rung_named, many = _places(ladder, "rung_name", rungs)
    of_rungs = _word_names("r", many)
    both = _words(b, "base_name", base_places, of_base).unionByName(_words(r, "rung_name", rung_places, of_rungs), allowMissingColumns=True)
    per_value = both.groupBy("value").agg(*[F.coalesce(F.bit_or(w), F.lit(0).cast("bigint")).alias(w) for w in of_base + of_rungs])
    counted = per_value.groupBy(*of_base, *of_rungs).agg(F.count(F.lit(1)).alias("n"))
    counted = compute_once(counted, *of_base, *of_rungs, base_named.alias("base_names"), rung_named.alias("rungs"), "n")
    base_set, rung_set = _set_of(of_base, F.col("base_names")), _set_of(of_rungs, F.col("rungs"))
    return compute_once(counted, base_set.alias("base_set"), rung_set.alias("rung_set"), "n")


def ladder_counts(
    base: DataFrame, ladder: DataFrame, base_names: Sequence[str] | None = None, rungs: Sequence[str] | None = None
) -> DataFrame:
    """Values of each base list whose first matching rung is this one: ``base_name, rung_name, n_new``."""
    base_names = base_names if base_names is not None else _names(base, "base_name", None)
    rungs = rungs if rungs is not None else _names(ladder, "rung_name", None)
    table = coverage(base, ladder, base_names, rungs)
    hits = table.where(F.size("rung_set") > 0).select(
        F.explode("base_set").alias("base_name"), F.get("rung_set", F.lit(0)).alias("rung_name"), "n"
    )
    base_rows = _name_rows(base, "base_name", base_names, "base_name")
    zero = F.lit(0).cast("bigint").alias("n")
    if rungs is not None:
        grid = base_rows.select("base_name", F.explode(F.array(*[F.lit(n) for n in rungs])).alias("rung_name"), zero)
    else:
        all_rungs = _name_rows(ladder, "rung_name", None, "rung_name").agg(F.collect_set("rung_name"))
        grid = base_rows.select("base_name", F.explode(all_rungs.scalar()).alias("rung_name"), zero)
    return (
        hits.unionByName(grid)
        .groupBy("base_name", "rung_name")
        .agg(F.sum("n").cast("bigint").alias("n_new"))
    )


def _sizes(lists: DataFrame, col: str, names: Sequence[str] | None) -> DataFrame:
    """Distinct size of each list, zero for one without values."""
    one = F.lit(1).cast("bigint").alias("n")
    zero = _name_rows(lists, col, names, col).select(col, F.lit(0).cast("bigint").alias("n"))
    return _asked(lists, col, names).distinct().select(col, one).unionByName(zero).groupBy(col).agg(F.sum("n").alias("size"))


def base_sizes(base: DataFrame, base_names: Sequence[str] | None = None) -> DataFrame:
    """Distinct size of each base list."""
    return _sizes(base, "base_name", base_names)


def ladder_sizes(ladder: DataFrame, rungs: Sequence[str] | None = None) -> DataFrame:
    """Distinct size of each rung, also of values no base list holds."""
    return _sizes(ladder, "rung_name", rungs)


def ladder_report(
    base: DataFrame, ladder: DataFrame, base_names: Sequence[str] | None = None, rungs: Sequence[str] | None = None
) -> DataFrame:
    """``base_name, rung_name, n_new, size``: counts next to the size of the base list.

    Size and hits come from the same pass: a row without rung carries the values no rung holds.
    """
    base_names = base_names if base_names is not None else _names(base, "base_name", None)
    rungs = rungs if rungs is not None else _names(ladder, "rung_name", None)
    table = coverage(base, ladder, base_names, rungs).select(
        F.explode("base_set").alias("base_name"), F.get("rung_set", F.lit(0)).alias("rung_name"), "n"
    )
    base_rows = _name_rows(base, "base_name", base_names, "base_name")
    zero = F.lit(0).cast("bigint").alias("n")
    if rungs is not None:
        grid = base_rows.select("base_name", F.explode(F.array(*[F.lit(n) for n in rungs])).alias("rung_name"), zero)
    else:
        all_rungs = _name_rows(ladder, "rung_name", None, "rung_name").agg(F.collect_set("rung_name"))
        grid = base_rows.select("base_name", F.explode(all_rungs.scalar()).alias("rung_name"), zero)
    cells = table.unionByName(grid).groupBy("base_name", "rung_name").agg(F.sum("n").alias("n_new"))
    per_base = Window.partitionBy("base_name")
    return cells.select(
        "base_name",
        "rung_name",
        F.col("n_new").cast("bigint").alias("n_new"),
        F.sum("n_new").over(per_base).cast("bigint").alias("size"),
    ).where(F.col("rung_name").isNotNull())


def ladder_percent(
    base: DataFrame, ladder: DataFrame, base_names: Sequence[str] | None = None, rungs: Sequence[str] | None = None
) -> DataFrame:
    """The ladder in percent of the size of the base list."""
    return ladder_report(base, ladder, base_names, rungs).select(
        "base_name", "rung_name", pct_of("n_new", "size").alias("pct")
    )


def ladder_totals(
    base: DataFrame, ladder: DataFrame, base_names: Sequence[str] | None = None, rungs: Sequence[str] | None = None
) -> DataFrame:
    """Values of each base list found on any rung, as count and percent."""
    return (
        ladder_report(base, ladder, base_names, rungs)
        .groupBy("base_name")
        .agg(F.sum("n_new").cast("bigint").alias("n_total"), F.max("size").alias("size"))
        .select("base_name", "n_total", pct_of("n_total", "size").alias("pct_total"))
    )


def ladder_powerset(
    base: DataFrame, ladder: DataFrame, base_names: Sequence[str] | None = None, rungs: Sequence[str] | None = None
) -> DataFrame:
    """Per base list, values by the exact set of rungs that hold them: ``base_name, rung_set, n``."""
    return (
        coverage(base, ladder, base_names, rungs)
        .where(F.size("rung_set") > 0)
        .select(F.explode("base_set").alias("base_name"), "rung_set", "n")
        .groupBy("base_name", "rung_set")
        .agg(F.sum("n").cast("bigint").alias("n"))
    )
