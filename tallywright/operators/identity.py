"""Long tables of attribute cells: ``key, attr, value, ts``.

Stored as Parquet partitioned by ``attr``, every restriction to one attribute prunes folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import _col
from ..runtime import durable


def scan_cells(cells: DataFrame, *attrs: str) -> DataFrame:
    return cells.where(F.col("attr").isin(*attrs) if len(attrs) > 1 else F.col("attr") == attrs[0])


def _version(ts: str, tie: str | None) -> Column:
    return F.struct(ts, tie) if tie else F.struct(ts)


def latest_per_key(cells: DataFrame, key: str = "key", value: str = "value", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Last version per key; ``tie`` orders versions with the same time."""
    best = cells.groupBy(key).agg(F.max(F.struct(_version(ts, tie).alias("v"), F.col(value).alias("value"))).alias("m"))
    return best.select(key, F.col("m.value").alias(value), F.col(f"m.v.{ts}").alias(ts))


def earliest_per_key(cells: DataFrame, key: str = "key", value: str = "value", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """First version per key."""
    best = cells.groupBy(key).agg(F.min(F.struct(_version(ts, tie).alias("v"), F.col(value).alias("value"))).alias("m"))
    return best.select(key, F.col("m.value").alias(value), F.col(f"m.v.{ts}").alias(ts))


def dump_lookup(cells: DataFrame, attr: str, tie: str | None = None) -> DataFrame:
    """One ``key, value`` row per key: the first cell of the attribute."""
    return earliest_per_key(scan_cells(cells, attr), tie=tie).select("key", "value")


def lookup_batch(
    keys: DataFrame,
    table: DataFrame,
    key: str,
    cols: Sequence[str],
    defaults: dict[str, object] | None = None,
    keep_missing: bool = True,
) -> DataFrame:
    """Rows of ``table`` for a set of keys; a key that is not found keeps its row with defaults.

    ``keep_missing=False`` returns the found rows only. The table is the probed side of a semi join: a small
    batch is broadcast, so the table does not move, and with a large one a key that holds a third of
    the table can be split. An outer join from the keys would allow neither. With ``keep_missing`` the rows found are
    stored first: what is missing is told from them, so the table is scanned once.
    """
    wanted = keys.select(key).distinct()
    found = table.select(key, *cols).join(wanted, key, "left_semi")
    if not keep_missing:
        return found
    found = durable(found)
    types = {f.name: f.dataType for f in table.schema.fields}
    missing = wanted.join(found.select(key).distinct(), key, "left_anti")
    fill = {c: (defaults or {}).get(c) for c in cols}
    return found.fillna(defaults or {}).unionByName(
        missing.select(key, *[F.lit(fill[c]).cast(types[c]).alias(c) for c in cols])
    )


def collect_lookup(keys: DataFrame, table: DataFrame, key: str, field: str) -> DataFrame:
    """The set of values of a multi-valued field per key, one ``key, value`` row each.

    A key without values has one row with a null. The set stays in rows: a key may hold any number of
    values. ``field`` may be an array column.
    """
    is_array = dict(table.dtypes)[field].startswith("array")
    values = table.select(key, (F.explode(field) if is_array else F.col(field)).alias("value"))
    return lookup_batch(keys, values.where(F.col("value").isNotNull()), key, ["value"]).distinct()


def duplicate_ids(cells: DataFrame, attr: str, tie: str | None = None) -> DataFrame:
    """Values of the attribute that are the latest one of more than one key: ``value, key, ts`` in order.

    A value shared by a third of all keys is counted with partial sums, and the rows are picked by a semi
    join that adaptive execution can split; its keys never meet in one task.
    """
    latest = latest_per_key(scan_cells(cells, attr), tie=tie)
    shared = latest.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("value")
    return latest.join(shared, "value", "left_semi").select("value", "key", "ts").orderBy("value", "key")


def recycled_ids(cells: DataFrame, attr: str) -> DataFrame:
    """Keys with more than one cell of the attribute and all their values: ``key, value, ts, n_cells``.

    One row per cell: the number of cells of a key has no bound, so they are not gathered into one row.
    """
    own = scan_cells(cells, attr).select("key", "value", "ts")
    many = own.groupBy("key").agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") > 1)
    return own.join(many, "key").select("key", "value", "ts", "n_cells")


def recycled_counts(cells: DataFrame, attr: str) -> DataFrame:
    """Keys with the attribute (``records``) and those among them with several cells (``hits``)."""
    per_key = scan_cells(cells, attr).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("n") > 1).alias("hits"))


def qualify_activity(
    keys: DataFrame,
    cells: DataFrame,
    *,
    followers: str,
    tweets: str,
    tags: str,
    good_tags: Sequence[str],
    now: Column | str | None = None,
    recent_only: bool = False,
    min_followers: int = 1,
    min_tweets: int = 2,
    tie: str | None = None,
) -> DataFrame:
    """``key, n_followers, n_tweets, tagged, active`` for every wanted key.

    Active: the earliest follower count reaches ``min_followers``, or there are ``min_tweets`` tweets, or one
    of the good tags is set. All tweets count unless ``recent_only``, which keeps those of the last year
    before ``now``. One conditional aggregate over the cells, then one join.
    """
    attr = F.col("attr")
    is_tweet = attr == tweets
    if recent_only:
        moment = F.current_timestamp() if now is None else _col(now)
        is_tweet = is_tweet & (F.col("ts") > F.add_months(moment, -12).cast("timestamp"))
    first = F.min(F.when(attr == followers, F.struct(_version("ts", tie).alias("v"), F.col("value").alias("value"))))
    facts = scan_cells(cells, followers, tweets, tags).groupBy("key").agg(
        first.getField("value").try_cast("bigint").alias("n_followers"),
        F.count_if(is_tweet).alias("n_tweets"),
        F.bool_or((attr == tags) & F.col("value").isin(*good_tags)).alias("tagged"),
    )
    joined = keys.select("key").distinct().join(facts, "key", "left")
    filled = joined.select(
        "key",
        F.coalesce("n_followers", F.lit(0)).alias("n_followers"),
        F.coalesce("n_tweets", F.lit(0)).alias("n_tweets"),
        F.coalesce("tagged", F.lit(False)).alias("tagged"),
    )
    active = (F.col("n_followers") >= min_followers) | (F.col("n_tweets") >= min_tweets) | F.col("tagged")
    return filled.withColumn("active", active)


def activity_route(qualified: DataFrame) -> DataFrame:
    """Label for the two outputs of the activity check."""
    return qualified.select("key", F.when(F.col("active"), "exist").otherwise("not_found").alias("route"))
