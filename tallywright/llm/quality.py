"""Quality rules whose thresholds follow each language and source, from mergeable quantile sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable, small_side
from .common import WORD_HASHES, bounded, only, raw, text_key, windows_hash

#: Characters counted as symbols (fixed by the rule).
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Relative error of the sketch's quantiles.
ERROR = 0.01
GAMMA = (1 + ERROR) / (1 - ERROR)
#: Groups with fewer rows than this use the merged sketch of their language, a language that of all rows, and where all
#: rows are fewer the constants below decide.
LEAST = 200
#: A row is rejected where a measure exceeds its group's ``TAIL`` quantile by more than the allowance, which leaves measures
#: that are mostly 0 a limit. Sketches hold the rows that pass the base rule; up to ``1 - TAIL`` of them may be bad
#: without moving the limit.
TAIL = 0.85
ALLOWANCE = {"symbol_share": 0.05, "dup_line_share": 0.4, "repeat_share": 0.28, "word_length": 1.5}
CONSTANTS = {"symbol_share": 0.08, "dup_line_share": 0.6, "repeat_share": 0.3, "word_length": 14.0}


def _measures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        rows = []
        for t in f["text"]:
            data = raw(t)
            words = data.split()
            n = len(words)
            chars = len(t) - (len(data) - sum(map(len, words))) if isinstance(t, str) else 0
            lines = [x for x in data.split(b"\n") if x.strip()]
            repeated = 0
            if n >= WINDOW:
                _, back, times = np.unique(windows_hash(WORD_HASHES.of(words), WINDOW), return_inverse=True, return_counts=True)
                twice = np.flatnonzero(times[back] > 1)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, twice, 1)
                np.add.at(edge, twice + WINDOW, -1)
                repeated = int((np.cumsum(edge[:-1]) > 0).sum())
            rows.append((n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)))
        got = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"], dtype="int64")
        yield pd.concat([f.drop(columns="text").reset_index(drop=True), got], axis=1)


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, text_key``, counts and shares of every row. A null text has none of anything."""
    fields = "doc_id long, lang string, source string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    rows = only(docs, ["doc_id", "lang", "source", "text"]).withColumn("text_key", text_key()).select("doc_id", "lang", "source", "text_key", "text")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return rows.mapInPandas(_measures, fields).select(
        "*",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("word_chars", "n_words").alias("word_length"),
    )


def sketch(rows: DataFrame, by: tuple[str, ...], names: tuple[str, ...]) -> DataFrame:
    """Log-bucket quantile sketch: rows per (group, measure, bucket).

    Counts of one bucket add up, so sketches merge in any order to the same result; a bucket's width bounds a
    quantile's relative error by ``ERROR``. Zero has a bucket of its own.
    """
    bucket = lambda c: F.when(F.col(c) > 0, F.ceil(F.log(c) / math.log(GAMMA))).otherwise(-(1 << 20)).cast("long")
    cells = F.array(*[F.struct(F.lit(n).alias("measure"), bucket(n).alias("bucket")) for n in names])
    return rows.select(*by, F.inline(cells)).groupBy(*by, "measure", "bucket").agg(F.count(F.lit(1)).alias("many"))


def merged(parts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The same sketch for larger groups."""
    return parts.groupBy(*by, "measure", "bucket").agg(F.sum("many").alias("many"))


def quantiles(parts: DataFrame, by: tuple[str, ...], wanted: dict[str, float]) -> DataFrame:
    """``by, measure, rows`` and one column per wanted quantile, read from a sketch."""
    group = Window.partitionBy(*by, "measure")  # buckets of one group: some thousands at most
    below = F.sum("many").over(group.orderBy("bucket"))
    ranked = parts.select("*", below.alias("below"), F.sum("many").over(group).alias("rows"))
    value = F.when(F.col("bucket") == -(1 << 20), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket").cast("double")) / (GAMMA + 1))
    at = [F.min(F.when(F.col("below") >= F.lit(q) * F.col("rows"), value)).alias(n) for n, q in wanted.items()]
    return ranked.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), *at)


def thresholds(rows: DataFrame) -> DataFrame:
    """``lang, source``, the highest accepted value of each measure and ``decided_by``, one row per group that occurs.

    ``decided_by`` names what the limits come from: ``group``, ``language`` or ``all`` (a sketch), or ``constants``.
    """
    names, ask = tuple(ALLOWANCE), {"tail": TAIL}
    fine = durable(sketch(rows.where("NOT base_failed"), ("lang", "source"), names))
    wide = durable(merged(fine, ("lang",)))
    own = quantiles(fine, ("lang", "source"), ask).select(F.col("lang").alias("ol"), F.col("source").alias("os"), F.col("measure").alias("om"), F.col("rows").alias("o_rows"), F.col("tail").alias("own"))
    lang = quantiles(wide, ("lang",), ask).select(F.col("lang").alias("ll"), F.col("measure").alias("lm"), F.col("rows").alias("l_rows"), F.col("tail").alias("of_lang"))
    whole = quantiles(merged(wide, ()), (), ask).select(F.col("measure").alias("wm"), F.col("rows").alias("w_rows"), F.col("tail").alias("of_all"))
    found = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    cells = found.select("lang", "source", F.explode(F.array(*[F.lit(n) for n in names])).alias("measure"))
    same = F.col("lang").eqNullSafe(F.col("ol")) & F.col("source").eqNullSafe(F.col("os")) & (F.col("measure") == F.col("om"))
    joined = cells.join(own, same, "left").join(lang, F.col("lang").eqNullSafe(F.col("ll")) & (F.col("measure") == F.col("lm")), "left")
    joined = joined.join(F.broadcast(whole), F.col("measure") == F.col("wm"), "left")
    of = lambda group, language, both, none: F.when(F.col("o_rows") >= LEAST, group).when(F.col("l_rows") >= LEAST, language).when(F.col("w_rows") >= LEAST, both).otherwise(none)
    value = lambda known: F.coalesce(*[F.when(F.col("measure") == n, F.lit(v)) for n, v in known.items()])
    top = of(*[F.col(c) + value(ALLOWANCE) for c in ("own", "of_lang", "of_all")], value(CONSTANTS))
    by = of(*map(F.lit, ("group", "language", "all", "constants")))
    return (
        joined.select("lang", "source", "measure", top.alias("top"), by.alias("by"))
        .groupBy("lang", "source")
        .agg(F.max("by").alias("decided_by"), *[F.max(F.when(F.col("measure") == n, F.col("top"))).alias(f"max_{n}") for n in names])
    )


def judged(docs: DataFrame) -> DataFrame:
    """Every row's counts with ``base_failed``, ``decided_by`` and ``kept`` (not base_failed, and no measure beyond its group's
    threshold).

    Null languages and sources are groups of their own. A null or empty text fails the base rule. Repeated rows are judged
    alike; no rows give no rows. Other columns are ignored.
    """
    rows = durable(measures(docs))
    tops = durable(thresholds(rows)).select(F.col("lang").alias("l"), F.col("source").alias("s"), "decided_by", *[f"max_{n}" for n in ALLOWANCE])
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    fits: Column = ~F.col("base_failed")
    for n in ALLOWANCE:
        fits = fits & (F.col(n) <= F.col(f"max_{n}"))
    return rows.join(small_side(tops), same).drop("l", "s").withColumn("kept", fits)


def decisions(docs: DataFrame) -> DataFrame:
    """How many groups and rows each kind of limit decides, and how many rows that pass the base rule each measure rejects."""
    over = [F.count_if(~F.col("base_failed") & (F.col(n) > F.col(f"max_{n}"))).alias(f"over_{n}") for n in ALLOWANCE]
    parts = judged(docs).groupBy("decided_by", "lang", "source").agg(F.count(F.lit(1)).alias("rows"), F.count_if("base_failed").alias("base_failed"), F.count_if("kept").alias("kept"), *over)
    names = ["rows", "base_failed", "kept", *[f"over_{n}" for n in ALLOWANCE]]
    return parts.groupBy("decided_by").agg(F.count(F.lit(1)).alias("groups"), *[F.sum(n).alias(n) for n in names])
