"""Append joins with fillers, and positional projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import drop_commas
from ..observed import Counted, watched


def pick(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns by position; negative positions count from the end."""
    return df.select(*[df.columns[i] for i in positions])


def index_list(index_lines: DataFrame, n_cols: int, value: str = "value") -> list[int]:
    """The last token of each line as column index, in line order.

    A list of chosen columns; it is read by the driver and may hold at most as many lines as fit a row.
    """
    lines = [r[0] for r in index_lines.select(F.element_at(F.split(value, ","), -1)).limit(n_cols + 1).collect()]
    if len(lines) > n_cols:
        raise ValueError(f"more column indexes than the {n_cols} columns of the data")
    return [int(x) for x in lines]


def pick_from_config(df: DataFrame, index_lines: DataFrame, value: str = "value") -> DataFrame:
    """Columns whose indexes are listed in a file; commas are removed from the chosen values.

    The indexes become a plain ``select``, so only those columns are read.
    """
    names = [df.columns[i] for i in index_list(index_lines, len(df.columns), value)]
    return df.select(*[drop_commas(F.col(n).cast("string")).alias(n) for n in names])


def _first(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (which must be total up to equal rows)."""
    first = df.groupBy(key).agg(F.min(F.struct(F.struct(*order).alias("o"), F.struct(*cols).alias("r"))).alias("m"))
    return first.select(key, *[F.col(f"m.r.{c}").alias(c) for c in cols])


def _filled(cols: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols]


def append_two_stage(
    base: DataFrame,
    mid: DataFrame,
    app: DataFrame,
    *,
    base_id: str,
    base_cols: Sequence[str],
    base_order: Sequence[str],
    mid_id: str,
    mid_key: str,
    mid_cols: Sequence[str],
    mid_order: Sequence[str],
    app_key: str,
    app_cols: Sequence[str],
    app_order: Sequence[str],
) -> DataFrame:
    """Base rows with the columns of their first ``app`` and first ``mid`` row appended, blanks where none.

    ``mid`` is reached by id, ``app`` through the key in ``mid``; keys that only the right sides hold are
    dropped, and repeated base ids keep their first row. Because only the first ``mid`` row of an id is
    appended, it is chosen before the join with ``app``, not after. Returns
    ``id, base_cols, app_cols, mid_cols`` as text.
    """
    first_base = _first(base, base_id, base_cols, base_order)
    first_mid = _first(mid, mid_id, [mid_key, *mid_cols] if mid_key not in mid_cols else list(mid_cols), mid_order)
    first_app = _first(app, app_key, app_cols, app_order)
    right = first_mid.select(
        F.col(mid_id).alias("_mid"), F.col(mid_key).alias("_key"), *[F.col(c).alias(f"_m_{c}") for c in mid_cols]
    ).join(
        first_app.select(F.col(app_key).alias("_app"), *[F.col(c).alias(f"_a_{c}") for c in app_cols]),
        F.col("_key") == F.col("_app"),
        "left",
    )
    joined = first_base.join(right, F.col(base_id) == F.col("_mid"), "left")
    return joined.select(
        F.col(base_id).cast("string").alias(base_id),
        *_filled(base_cols),
        *[F.coalesce(F.col(f"_a_{c}").cast("string"), F.lit("")).alias(c) for c in app_cols],
        *[F.coalesce(F.col(f"_m_{c}").cast("string"), F.lit("")).alias(c) for c in mid_cols],
    )


def append_counted(base: DataFrame, mid: DataFrame, app: DataFrame, **names) -> Counted:
    """``append_two_stage`` and, from the same pass, how many base ids met a row.

    ``records``, ``with_mid``, ``without_mid`` (``only_base`` of ``append_match_counts``), ``with_app``, ``without_app``.
    Marks ride along as constant columns of the right sides and go before the rows are handed on.
    """
    marked = {"mid": mid.withColumn("_has_mid", F.lit("1")), "app": app.withColumn("_has_app", F.lit("1"))}
    more = names | {"mid_cols": [*names["mid_cols"], "_has_mid"], "app_cols": [*names["app_cols"], "_has_app"]}
    joined = append_two_stage(base, marked["mid"], marked["app"], **more)
    rows, seen = watched(
        joined,
        {"records": F.count(F.lit(1))}
        | {f"with_{side}": F.count_if(F.col(f"_has_{side}") == "1") for side in ("mid", "app")}
        | {f"without_{side}": F.count_if(F.col(f"_has_{side}") == "") for side in ("mid", "app")},
    )
    return Counted(rows.drop("_has_mid", "_has_app"), seen, ["records", "with_mid", "without_mid", "with_app", "without_app"])


def append_match_counts(
    base: DataFrame, mid: DataFrame, app: DataFrame, *, base_id: str, mid_id: str, mid_key: str, app_key: str
) -> DataFrame:
    """``only_mid``: mid rows without an app row; ``only_base``: base ids without a mid row.

    Rows are counted per key before they meet, so no key is joined more than once.
    """

    def unmatched(left: DataFrame, key: str, right: DataFrame, other: str) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        both = left.select(F.col(key).alias("k"), F.lit(1).cast("bigint").alias("n"), zero.alias("hit")).unionByName(
            right.select(F.col(other).alias("k"), zero.alias("n"), F.lit(1).cast("bigint").alias("hit"))
        )
        per_key = both.groupBy("k").agg(F.sum("n").alias("n"), F.max("hit").alias("hit"))
        lost = F.when((F.col("hit") == 0) | F.col("k").isNull(), F.col("n"))
        return per_key.agg(F.coalesce(F.sum(lost), F.lit(0)).cast("bigint").alias("n"))

    only_mid = unmatched(mid, mid_key, app, app_key).select(F.lit("only_mid").alias("counter"), "n")
    only_base = unmatched(base.select(base_id).distinct(), base_id, mid, mid_id)
    return only_mid.unionByName(only_base.select(F.lit("only_base").alias("counter"), "n"))
