"""Session-level helpers: durable intermediate results and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when both bounds hold.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 32 * 1024 * 1024
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker at once, where ``narrow_batches`` holds.
BATCH_BYTES = 4 * 1024 * 1024
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application.

    Functions that run in tasks are looked up by module there, and an executor neither has the driver's folder nor
    its search path. The sources go as one small archive through Spark's own file transfer.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tallywright-src-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for durable intermediate data.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where one machine is the
    whole cluster, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tallywright-")
    spark.sparkContext.setCheckpointDir(made)
    return made


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside pass rows to Python workers in batches of few bytes.

    A batch is built beside the heap, in buffers that double as they grow and stay until the task ends; one of ten thousand
    wide rows would take several times its size there.
    """
    before = spark.conf.get(BATCH_LIMIT, None)
    spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_LIMIT)
        else:
            spark.conf.set(BATCH_LIMIT, before)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a table in the shared folder and read it from there.

    Needed where several branches must see the very same rows and placement even if an executor is lost
    between them. As a column store each branch reads only what it uses. Shuffle files of the job are given
    back at its end: the table replaces them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallywright/{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``df`` with a broadcast hint if its size is proven small, else ``df`` unchanged.

    The probe reads at most ``max_rows + 1`` rows. Beyond the bound the join stays a shuffled join,
    which adaptive execution splits where a key is hot.
    """
    size = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, chars = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    if rows <= max_rows and (chars or 0) <= max_chars:
        return F.broadcast(df)
    return df


def compute_once(df: DataFrame, *cols: Column | str) -> DataFrame:
    """``select`` whose expressions are evaluated exactly once per row.

    A later filter or generator on a costly column would otherwise be pushed below the projection and
    evaluate the column again. A one-entry ``inline`` keeps it from that without leaving code generation.
    Names pass by as they are, so pruning and pushdown still work on them; they come first in the result.
    """
    names = [c for c in cols if isinstance(c, str)]
    made = [c for c in cols if not isinstance(c, str)]
    return df.select(*names, F.inline(F.array(F.struct(*made))))


def rows_of(df: DataFrame, key: str, value: str, pairs: list[tuple[str, Column]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn named columns of a (small) frame into ``key, value`` rows in the order given."""
    cells = [F.struct(F.lit(i).alias("_pos"), F.lit(n).alias(key), c.alias(value)) for i, (n, c) in enumerate(pairs)]
    return df.select(*keep, F.inline(F.array(*cells)))


def null_safe(left: str, right: str, pairs: list[tuple[str, str]]) -> Column:
    """Conjunction of null-safe equalities between two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in pairs])
