"""Sinks. Blank text replaces nulls only here."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import csv_line
from ..runtime import durable


def write_text(df: DataFrame, path: str, n_files: int | None = None, mode: str = "errorifexists") -> None:
    """Rows as comma-separated lines; ``n_files`` spreads them over that many files.

    The rows are moved (not coalesced), so the stage before keeps its parallelism.
    """
    lines = df.select(csv_line(*df.columns).alias("value"))
    (lines.repartition(n_files) if n_files else lines).write.mode(mode).text(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A small result as one quoted CSV file with a header."""
    df.repartition(1).write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path)


def route(df: DataFrame, rules: Sequence[tuple[str, Column]], default: str, out: str = "route") -> DataFrame:
    """Label each row with the output it belongs to."""
    label: Column | None = None
    for name, test in rules:
        label = F.when(test, name) if label is None else label.when(test, name)
    return df.withColumn(out, F.lit(default) if label is None else label.otherwise(default))


def write_routes(df: DataFrame, path: str, out: str = "route", mode: str = "errorifexists") -> None:
    """One folder per label."""
    df.write.mode(mode).partitionBy(out).parquet(path)


def export_named(df: DataFrame, name_col: str, path: str, mode: str = "errorifexists") -> None:
    """``value`` lines of each name under their own folder."""
    df.select(name_col, "value").write.mode(mode).partitionBy(name_col).text(path)


def write_cells(cells: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Cells in one folder per attribute, so that a scan of some attributes reads no other."""
    cells.repartition("attr", F.pmod(F.xxhash64("key"), F.lit(cells.sparkSession.sparkContext.defaultParallelism))).write.mode(mode).partitionBy("attr").parquet(path)


def write_dated(df: DataFrame, base: str, day: str, mode: str = "errorifexists") -> None:
    """A snapshot in its own folder ``base/day``, as ``readers.resolve_dated`` looks for; ``day`` is eight digits."""
    if len(day) != 8 or not (day.isascii() and day.isdigit()):
        raise ValueError(f"a day has eight digits: {day!r}")
    df.write.mode(mode).parquet(f"{base.rstrip('/')}/{day}")


def deliver_once(df: DataFrame, send: Callable[[str], None], ledger: str, payload: str = "payload") -> DataFrame:
    """``deliver`` of the payloads that no earlier call has sent with success: ``outcome, payload``.

    Outcomes are kept under ``ledger`` by a digest of the payload, so a rerun sends only what failed or is new. Equal
    payloads are sent once. A run that is lost before its outcomes are kept sends again, as ``deliver`` may.
    """
    spark = df.sparkSession
    digest = F.sha2(F.col(payload), 256).alias("digest")
    todo = df.select(payload).where(F.col(payload).isNotNull()).distinct().select(payload, digest)
    at = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        kept = spark.read.schema("digest string, outcome string").parquet(ledger)
        todo = todo.join(kept.where("outcome = 'success'").select("digest"), "digest", "left_anti")
    outcomes = durable(deliver(todo, send, payload))
    outcomes.select(F.sha2("payload", 256).alias("digest"), "outcome").write.mode("append").parquet(ledger)
    return outcomes


def deliver(df: DataFrame, send: Callable[[str], None], payload: str = "payload") -> DataFrame:
    """Send every payload with a function of the caller and keep ``outcome, payload``.

    A record whose call raises is a ``failure``. A task that is run again sends its records again, so the
    receiver has to accept repeats.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            outcomes = []
            for text in batch[payload]:
                try:
                    send(text)
                    outcomes.append("success")
                except Exception:
                    outcomes.append("failure")
            yield pd.DataFrame({"outcome": outcomes, "payload": batch[payload]})

    return df.select(payload).mapInPandas(run, "outcome string, payload string")
