"""Rows and the counters about them from one pass: the job that writes the rows also makes the counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .runtime import durable


@dataclass
class Counted:
    """``rows`` carry an observation; ``counters()`` is known once an action has gone through all of them.

    The observed frame has to be evaluated by the last stage of that action: tasks of an earlier stage may be run
    again after an executor is lost, and would be counted twice. Counters belong to the first action.
    """

    rows: DataFrame
    _seen: Observation
    _names: list[str]

    def counters(self) -> dict[str, int]:
        """The counters of the first action over ``rows``; waits for its end."""
        got = self._seen.get
        return {n: int(got[n] or 0) for n in self._names}

    def stored(self) -> tuple[DataFrame, DataFrame]:
        """The rows, written once to the shared folder, and ``counter, n`` rows made by that same job."""
        kept = durable(self.rows)
        made = [(i, n, v) for i, (n, v) in enumerate(self.counters().items())]
        return kept, kept.sparkSession.createDataFrame(made, "pos int, counter string, n long").select("counter", "n")


def watched(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of the named aggregates; rows added or dropped later do not change them."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen


def counted(df: DataFrame, counters: dict[str, Column]) -> Counted:
    """``df`` with counters about its own rows."""
    rows, seen = watched(df, counters)
    return Counted(rows, seen, list(counters))


def total(col: Column | str) -> Column:
    """Sum that is 0 where there is nothing to add."""
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")
