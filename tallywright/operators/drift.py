"""What changed between two snapshots.

Both sides are stacked and aggregated instead of joined: each aggregate merges map-side, so a key that
holds a large share of the rows is a handful of partial rows by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pct_change
from ..observed import Counted, counted
from ..runtime import compute_once, durable, rows_of, small_side
from .rank import ordered

STATUSES = ("added", "deleted", "constant", "changed")
UNKNOWN = "Unk"


def _status(old: Column, new: Column, same: Column) -> Column:
    return F.when(old == 0, "added").when(new == 0, "deleted").when(same, "constant").otherwise("changed")


def _stack(old: DataFrame, new: DataFrame) -> DataFrame:
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    a = old.withColumn("_old", one).withColumn("_new", zero)
    return a.unionByName(new.withColumn("_old", zero).withColumn("_new", one))


def _summary(statuses: DataFrame) -> DataFrame:
    totals = statuses.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    return rows_of(totals, "status", "n", [(s, F.col(s)) for s in STATUSES]).select("status", "n")


def drift_pairs(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Status per key by the *set* of its values on either side."""
    per_pair = (
        _stack(old.select(key, value), new.select(key, value))
        .groupBy(key, value)
        .agg(F.max("_old").alias("o"), F.max("_new").alias("n"))
    )
    per_key = per_pair.groupBy(key).agg(
        F.max("o").alias("o"), F.max("n").alias("n"), F.bool_and(F.col("o") == F.col("n")).alias("same")
    )
    return per_key.select(key, _status(F.col("o"), F.col("n"), F.col("same")).alias("status"))


def drift_pairs_summary(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    return _summary(drift_pairs(old, new, key, value))


def drift_distribution(old: DataFrame, new: DataFrame, key: str, count: str, order: str | None = None) -> DataFrame:
    """Difference of two value distributions; a key absent on one side counts as zero there.

    A key that occurs more than once on a side keeps its first count by ``order`` (the smallest count
    when no order is given).
    """
    picked = [F.col(key), F.col(count).cast("double").alias("c")]
    picked += [F.col(order).alias("by")] if order else []
    stacked = old.select(*picked, F.lit(True).alias("is_old")).unionByName(new.select(*picked, F.lit(False).alias("is_old")))

    def first(side: Column) -> Column:
        # without an order the buffer is a plain number, which keeps the aggregate hash-based
        found = F.min(F.when(side, F.struct("by", "c"))).getField("c") if order else F.min(F.when(side, F.col("c")))
        return F.coalesce(found, F.lit(0.0))

    sides = stacked.groupBy(key).agg(first(F.col("is_old")).alias("old"), first(~F.col("is_old")).alias("new"))
    pct = pct_change("old", "new")
    return sides.select(
        key,
        F.col("old").alias("old_count"),
        F.col("new").alias("new_count"),
        (F.col("new") - F.col("old")).alias("diff"),
        pct.alias("pct"),
        F.abs(pct).alias("abs_pct"),
    )


def drift_records(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Status per key by whole records; repeated records are compared as multisets.

    ``n_old`` and ``n_new`` are the numbers of records of the key on either side.
    """
    names = old.columns
    per_record = (
        _stack(old, new.select(*names)).groupBy(*names).agg(F.sum("_old").alias("o"), F.sum("_new").alias("n"))
    )
    per_key = per_record.groupBy(key).agg(
        F.sum("o").alias("n_old"), F.sum("n").alias("n_new"), F.bool_and(F.col("o") == F.col("n")).alias("same")
    )
    return per_key.select(key, "n_old", "n_new", _status(F.col("n_old"), F.col("n_new"), F.col("same")).alias("status"))


def _record_counters() -> dict[str, Column]:
    return {s: F.count_if(F.col("status") == s) for s in STATUSES} | {"in_both": F.count_if((F.col("n_old") > 0) & (F.col("n_new") > 0))}


def drift_records_counted(old: DataFrame, new: DataFrame, key: str) -> Counted:
    """``drift_records`` and, from the same pass, the counters of ``drift_records_summary``."""
    return counted(drift_records(old, new, key), _record_counters())


def drift_records_summary(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys per status, and keys present in both snapshots (status ``in_both``)."""
    totals = drift_records(old, new, key).agg(*[c.alias(s) for s, c in _record_counters().items()])
    return rows_of(totals, "status", "n", [(s, F.col(s)) for s in totals.columns]).select("status", "n")


def field_changes(
    old: DataFrame,
    new: DataFrame,
    key: str,
    fields: Sequence[str],
    expand: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Raw transitions ``key, field, old_code, new_code, coded`` of keys whose records differ.

    The two sides meet once, keyed by record, and the fields are compared inside the row, so the number
    of fields does not multiply what is shuffled. Only a field the new record holds (not null) counts; a
    blank new value and a missing old value stand for ``Unk``. A field named in ``expand`` reports the raw
    fields listed there instead, each on its own (``coded`` is false for those).
    """
    expand = dict(expand or {})
    names = [c for c in old.columns if c != key]
    record = F.struct(*names)
    stacked = old.select(key, record.alias("rec"), F.lit(True).alias("is_old")).unionByName(
        new.select(key, F.struct(*names).alias("rec"), F.lit(False).alias("is_old"))
    )
    # multiset comparison needs the count per record, the report needs one record per side
    per_record = stacked.groupBy(key, "rec").agg(
        F.count_if(F.col("is_old")).alias("o"), F.count_if(~F.col("is_old")).alias("n")
    )
    per_key = per_record.groupBy(key).agg(
        F.min(F.when(F.col("o") > 0, F.col("rec"))).alias("old_rec"),
        F.min(F.when(F.col("n") > 0, F.col("rec"))).alias("new_rec"),
        F.bool_and(F.col("o") == F.col("n")).alias("same"),
    )
    changed = per_key.where(F.col("old_rec").isNotNull() & F.col("new_rec").isNotNull() & ~F.col("same"))

    def pair(side: str, name: str) -> Column:
        return F.col(side).getField(name).cast("string")

    def cell(name: Column | str, before: Column, after: Column, coded: bool, show: Column) -> Column:
        body = F.struct(
            F.lit(name).alias("field"), before.alias("old_code"), after.alias("new_code"), F.lit(coded).alias("coded")
        )
        return F.when(show, body)

    cells = []
    for f in fields:
        before, after = F.coalesce(pair("old_rec", f), F.lit(UNKNOWN)), pair("new_rec", f)
        differs = F.when(after == "", F.lit(UNKNOWN)).otherwise(after) != before
        if f in expand:
            for raw in expand[f]:
                a, b = pair("old_rec", raw), pair("new_rec", raw)
                cells.append(cell(raw, a, b, False, differs & ~a.eqNullSafe(b)))
        else:
            cells.append(cell(f, before, after, True, differs))
    listed = compute_once(changed, key, F.array_compact(F.array(*cells)).alias("cells"))
    return listed.select(key, F.inline("cells"))


def displayed_fields(dictionary: DataFrame, columns: Sequence[str], category: str = "Demog") -> dict[str, str]:
    """The record's columns the dictionary displays, with their titles; bounded by the width of the record."""
    wanted = dictionary.where((F.col("category") == category) & F.col("field").isin(list(columns)))
    found = {r["field"]: r["title"] for r in wanted.groupBy("field").agg(F.min("title").alias("title")).collect()}
    return {c: found[c] for c in columns if c in found}


def _labelled(changes: DataFrame, dictionary: DataFrame, titles: Mapping[str, str], category: str) -> DataFrame:
    """Field titles and value names in place of codes; an unknown code is ``Unk``."""
    shown = dictionary.where((F.col("category") == category) & F.col("field").isin(list(titles)))
    names = small_side(shown.groupBy("field", "value").agg(F.min("value_name").alias("value_name")))
    before, after = names.toDF("b_field", "b_code", "b_name"), names.toDF("a_field", "a_code", "a_name")
    joined = changes.join(
        before, (F.col("field") == F.col("b_field")) & (F.col("old_code") == F.col("b_code")), "left"
    ).join(after, (F.col("field") == F.col("a_field")) & (F.col("new_code") == F.col("a_code")), "left")

    def text(name: str, code: str) -> Column:
        return F.when(F.col("coded"), F.coalesce(F.col(name), F.lit(UNKNOWN))).otherwise(F.coalesce(F.col(code), F.lit("")))

    label = F.col("field")
    for field, title in titles.items():
        label = F.when(F.col("coded") & (F.col("field") == field), title).otherwise(label)
    return joined.withColumns(
        {"field_label": label, "old_label": text("b_name", "old_code"), "new_label": text("a_name", "new_code")}
    )


def drift_fields(
    old: DataFrame,
    new: DataFrame,
    key: str,
    dictionary: DataFrame,
    expand: Mapping[str, Sequence[str]] | None = None,
    category: str = "Demog",
) -> DataFrame:
    """One row per changed, displayed field: ``key, field_label, old_label, new_label``.

    ``dictionary`` has ``title, field, value, value_name, category`` rows (see ``flatten_dictionary``).
    """
    dictionary = durable(dictionary)  # read several times below
    titles = displayed_fields(dictionary, [c for c in new.columns if c != key], category)
    changes = field_changes(old, new, key, list(titles), expand)
    return _labelled(changes, dictionary, titles, category).select(key, "field_label", "old_label", "new_label")


def transition_counts(
    old: DataFrame,
    new: DataFrame,
    key: str,
    dictionary: DataFrame,
    expand: Mapping[str, Sequence[str]] | None = None,
    category: str = "Demog",
) -> DataFrame:
    """How often each (field, old label, new label) occurs, ordered.

    Codes are counted first, so labels are looked up once per distinct transition, not per record.
    """
    dictionary = durable(dictionary)  # read several times below
    titles = displayed_fields(dictionary, [c for c in new.columns if c != key], category)
    changes = field_changes(old, new, key, list(titles), expand)
    counted = changes.groupBy("field", "old_code", "new_code", "coded").agg(F.count(F.lit(1)).alias("n"))
    labels = ["field_label", "old_label", "new_label"]
    return ordered(_labelled(counted, dictionary, titles, category).groupBy(*labels).agg(F.sum("n").cast("bigint").alias("n")), *labels)


def regression_check(old: DataFrame, new: DataFrame, checks: Sequence[tuple[str, float]]) -> DataFrame:
    """Rows meeting each predicate before and after, the change in percent and whether it exceeds its limit.

    All predicates are counted in one scan per side. Only growth is flagged, as NaN is larger than
    nothing.
    """
    hits = [F.count_if(F.expr(p)).alias(f"c{i}") for i, (p, _) in enumerate(checks)]
    sides = old.agg(*hits).withColumn("side", F.lit("old")).unionByName(new.agg(*hits).withColumn("side", F.lit("new")))
    long = rows_of(sides, "pos", "n", [(str(i), F.col(f"c{i}")) for i in range(len(checks))], keep=("side",))
    both = long.groupBy("_pos").agg(
        F.max(F.when(F.col("side") == "old", F.col("n"))).alias("old_count"),
        F.max(F.when(F.col("side") == "new", F.col("n"))).alias("new_count"),
    )
    texts = F.array(*[F.lit(p) for p, _ in checks])
    limits = F.array(*[F.lit(float(x)) for _, x in checks])
    pct = pct_change("old_count", "new_count")
    allowed = F.get(limits, F.col("_pos"))
    return both.select(
        F.get(texts, F.col("_pos")).alias("predicate"),
        "old_count",
        "new_count",
        pct.alias("pct"),
        allowed.alias("allowed_pct"),
        (~F.isnan(pct) & (pct > allowed)).alias("flagged"),
    )


def _blank(fields: Sequence[str]) -> Column:
    return F.forall(F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), lambda x: x == "")


def _checked(df: DataFrame, key: str, ignore_last: bool) -> list[str]:
    fields = [c for c in df.columns if c != key]
    return fields[:-1] if ignore_last else fields


def empty_records(df: DataFrame, key: str, ignore_last: bool = True) -> DataFrame:
    """Keys of records with nothing but blanks besides the key (and the last declared column)."""
    return df.where(_blank(_checked(df, key, ignore_last))).select(key)


def nonempty_records(df: DataFrame, key: str, ignore_last: bool = True) -> DataFrame:
    return df.where(~_blank(_checked(df, key, ignore_last))).select(key)


def newly_empty(cur: DataFrame, prev: DataFrame, key: str, ignore_last: bool = True) -> DataFrame:
    """Keys empty now that were not empty before."""
    return empty_records(cur, key, ignore_last).join(nonempty_records(prev, key, ignore_last), key, "left_semi")
