"""Row rules: first match wins, ready-made filters, complements and normalisation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import compute_once

# Fixed values (coded fields of a household record that contradict each other, in the order they are tried)
CONFLICT_RULES = (
    ("code1", "k_gender = 'F' AND k_hh_composition = 'J'"),
    ("code2", "k_gender = 'F' AND k_hh_composition = 'I'"),
    ("code3", "k_gender = 'M' AND k_hh_composition = 'L'"),
    ("code4", "k_gender = 'M' AND k_hh_composition = 'K'"),
    ("code5", "k_hh_composition = 'B' AND k_children_present = 'Y'"),
    ("code6", "k_hh_composition = 'D' AND k_children_present = 'Y'"),
    ("code7", "k_hh_composition = 'F' AND k_children_present = 'Y'"),
    ("code8", "k_hh_composition = 'H' AND k_children_present = 'Y'"),
    ("code9", "k_hh_composition = 'J' AND k_children_present = 'Y'"),
    ("code10", "k_hh_composition = 'L' AND k_children_present = 'Y'"),
    ("code11", "k_children_present = '' AND k_children_0_2 = 'Y'"),
    ("code12", "k_children_present = '' AND k_children_3_5 = 'Y'"),
    ("code13", "k_children_present = '' AND k_children_6_10 = 'Y'"),
    ("code14", "k_children_present = '' AND k_children_11_15 = 'Y'"),
    ("code15", "k_children_present = '' AND k_children_16_18 = 'Y'"),
)


def conflict_rules() -> list[tuple[str, str]]:
    """The fifteen conflict rules as ``(label, SQL predicate)``, in the order they are tried."""
    return list(CONFLICT_RULES)


def classify(df: DataFrame, rules: Sequence[tuple[str, str]], default: str = "perfect", out: str = "label") -> DataFrame:
    """Label each row with the first rule it meets."""
    label: Column | None = None
    for name, test in rules:
        label = F.when(F.expr(test), name) if label is None else label.when(F.expr(test), name)
    return df.withColumn(out, F.lit(default) if label is None else label.otherwise(default))


def reject(df: DataFrame, pred: Column | str) -> DataFrame:
    """Rows for which the predicate does not hold (an unknown outcome counts as "does not hold")."""
    test = F.expr(pred) if isinstance(pred, str) else pred
    return df.where(~F.coalesce(test, F.lit(False)))


# fixed value: what counts as blank at either end, i.e. everything up to the space
_BLANKS = "".join(chr(i) for i in range(33))


def drop_blank_normalised(df: DataFrame, col: str) -> DataFrame:
    """Trim blanks and control characters, lower-case, and drop what is then empty."""
    others = [c for c in df.columns if c != col]
    cleaned = F.lower(F.btrim(F.col(col).cast("string"), F.lit(_BLANKS)))
    return compute_once(df, *others, cleaned.alias(col)).where(F.col(col) != "").select(*df.columns)


def search_filter(
    df: DataFrame,
    *,
    tag: tuple[str, str] | None = None,
    at_least: tuple[str, float] | None = None,
    has: str | None = None,
    flag: str | None = None,
    created: str = "created_at",
    window_days: int | None = None,
    now: Column | datetime | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Conjunction of the usual search filters; each argument that is given adds one condition.

    ``tag`` is (array column, wanted tag); ``between`` starts at the beginning of its first day. Plain
    column comparisons, so they reach the Parquet scan.
    """
    if tag is not None:
        df = df.where(F.array_contains(F.col(tag[0]), tag[1]))
    if at_least is not None:
        df = df.where(F.col(at_least[0]) >= at_least[1])
    if has is not None:
        df = df.where(F.col(has).isNotNull())
    if flag is not None:
        df = df.where(F.col(flag))
    if window_days is not None:
        end = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
        start = end - F.make_dt_interval(F.lit(window_days))
        df = df.where((F.col(created) >= start) & (F.col(created) <= end))
    if between is not None:
        first = between[0].replace(hour=0, minute=0, second=0, microsecond=0)
        df = df.where(F.col(created).between(F.lit(first), F.lit(between[1])))
    return df
