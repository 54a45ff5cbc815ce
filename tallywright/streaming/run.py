"""Micro-batch runs over any streaming source."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..observed import counted

Batch = Callable[[DataFrame, int], None]

PRINT_SECONDS = 600  # fixed value: pause between progress prints


def rate_options(kind: str, rate: int, batch_seconds: int = 1, records_per_file: int = 1) -> dict[str, str]:
    """Source options for at most ``rate`` records per second over all partitions of the source.

    Spark has no per-receiver rate any more; the limit becomes the size of a batch. There is no floor: a source that
    waits for a least number of records would stall when few arrive.
    """
    if kind == "rate":
        return {"rowsPerSecond": str(rate)}
    if kind == "kafka":
        return {"maxOffsetsPerTrigger": str(rate * batch_seconds)}
    if kind == "files":
        return {"maxFilesPerTrigger": str(max(1, rate * batch_seconds // records_per_file))}
    raise ValueError(f"no rate option for source {kind!r}")


def run_stream(
    stream: DataFrame,
    each_batch: Batch,
    checkpoint: str,
    *,
    batch_seconds: int | None = None,
    output_mode: str = "append",
    stop_after: float | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run a stream into ``each_batch(df, batch_id)``.

    Without ``batch_seconds`` everything available is processed and the query ends by itself. With it a batch
    starts at that interval, until ``stop_after`` seconds have passed or forever; a batch that runs then is
    finished first. The progress lives in ``checkpoint``; a batch may be repeated after a failure, so the sink should be
    idempotent per batch id.
    """
    writer = stream.writeStream.foreachBatch(each_batch).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if batch_seconds is None else {"processingTime": f"{batch_seconds} seconds"}
    query = writer.trigger(**trigger).start()
    finished = query.awaitTermination(stop_after) if stop_after is not None else query.awaitTermination()
    if finished is False:
        _finish_batch(query)
        query.stop()
    return query


def _finish_batch(query: StreamingQuery) -> None:
    """Wait until no batch runs, or until the one that ran is done and the next has only just begun."""
    before = query.lastProgress
    while query.isActive and query.status["isTriggerActive"]:
        now = query.lastProgress
        if now is not None and (before is None or now.batchId != before.batchId):
            return
        query.awaitTermination(0.1)


def count_stream(stream: DataFrame, *cols: str) -> DataFrame:
    """Running counts per group; the state is one row per group."""
    return stream.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


class Ledger:
    """Totals of named counters over the batches of a stream, in a folder; they outlive a restart.

    After each batch one row holds the totals up to and including it (``at`` is its id). A batch that is repeated
    starts again from the row before it, so it counts once. Only the last ``KEEP`` rows are kept, so the folder
    does not grow with the number of batches.
    """

    KEEP = 8

    def __init__(self, spark: SparkSession, folder: str, counters: Iterable[str]):
        self.spark, self.folder, self.names = spark, folder, list(counters)
        self.schema = ", ".join(f"`{n}` long" for n in self.names)
        self._last: tuple[int, dict[str, int]] | None = None

    def _held(self) -> list[int]:
        """Batch ids that have a finished row."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            return []
        return sorted(int(s.getPath().getParent().getName().removeprefix("at=")) for s in files.globStatus(path.suffix("/at=*/_SUCCESS")))

    def _row(self, at: int) -> dict[str, int]:
        stored = self.spark.read.schema(self.schema).parquet(f"{self.folder}/at={at}").first()
        return {n: stored[n] for n in self.names}

    def before(self, batch_id: int | None = None) -> dict[str, int]:
        """Totals of all batches before this one, or of all."""
        if self._last is not None and batch_id is not None and self._last[0] == batch_id - 1:
            return self._last[1]
        held = [b for b in self._held() if batch_id is None or b < batch_id]
        return self._row(held[-1]) if held else dict.fromkeys(self.names, 0)

    def add(self, batch_id: int, counts: dict[str, int]) -> dict[str, int]:
        """Enter a batch; gives the totals with it."""
        base = self.before(batch_id)
        totals = {n: base[n] + counts[n] for n in self.names}
        row = self.spark.createDataFrame([tuple(totals[n] for n in self.names)], self.schema)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/at={batch_id}")
        for old in [b for b in self._held() if b <= batch_id][: -self.KEEP]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/at={old}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        self._last = (batch_id, totals)
        return totals


def counting_batches(
    counters: dict[str, str],
    folder: str,
    each_batch: Batch | None = None,
    show: Callable[[str], None] | None = None,
    every: float = PRINT_SECONDS,
) -> Batch:
    """A batch function that keeps named counters (SQL predicates) over the batches of a run.

    The counters of a batch are observed while ``each_batch`` goes through its rows, which it must do at least once, in
    full and first of all; a batch is read once. Without ``each_batch`` rows are only counted. Totals
    are kept in a ``Ledger`` before the batch is committed, so each batch counts exactly once. ``show`` receives a line at
    most every ``every`` seconds.
    """
    last = [time.monotonic()]
    ledgers: list[Ledger] = []

    def run(df: DataFrame, batch_id: int) -> None:
        if not ledgers:
            ledgers.append(Ledger(df.sparkSession, folder, counters))
        seen = counted(df, {n: F.count_if(F.expr(p)) for n, p in counters.items()})
        if each_batch is not None:
            each_batch(seen.rows, batch_id)
        else:
            seen.rows.write.format("noop").mode("overwrite").save()
        totals = ledgers[0].add(batch_id, seen.counters())
        if show is not None and time.monotonic() - last[0] >= every:
            show(_line(totals))
            last[0] = time.monotonic()

    return run


def _line(totals: dict[str, int]) -> str:
    return ", ".join(f"{n}={v}" for n, v in totals.items())


class Progress(StreamingQueryListener):
    """Shows the totals of a run at most every ``every`` seconds, also while no rows arrive, and when it ends.

    Add it to ``spark.streams`` before the run. It reads the ledger only when there is something to show, and only for
    queries of the given name, if one is given.
    """

    def __init__(self, ledger: Ledger, show: Callable[[str], None], every: float = PRINT_SECONDS, name: str | None = None):
        self.ledger, self.show, self.every, self.name = ledger, show, every, name
        self._runs: set[str] = set()
        self._last = time.monotonic()

    def _tell(self) -> None:
        self.show(_line(self.ledger.before()))
        self._last = time.monotonic()

    def onQueryStarted(self, event) -> None:
        if self.name is None or event.name == self.name:
            self._runs.add(str(event.runId))

    def _later(self, run_id: str) -> None:
        if run_id in self._runs and time.monotonic() - self._last >= self.every:
            self._tell()

    def onQueryProgress(self, event) -> None:
        self._later(str(event.progress.runId))

    def onQueryIdle(self, event) -> None:
        self._later(str(event.runId))

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._runs:
            self._tell()


def counted_so_far(spark: SparkSession, folder: str, counters: Iterable[str]) -> DataFrame:
    """One row with the sum of each counter over all batches entered under ``folder``."""
    ledger = Ledger(spark, folder, counters)
    totals = ledger.before()
    return spark.createDataFrame([tuple(totals[n] for n in ledger.names)], ledger.schema)
