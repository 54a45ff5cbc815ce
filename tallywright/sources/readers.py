"""Readers for delimited text, documents and dated folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import _col, drop_commas
from ..operators.profiles import parse_profiles
from ..runtime import durable, small_side


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_positional(spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text without quoting, columns by position; fields missing at the end of a line are null."""
    return spark.read.schema(_strings(names)).option("sep", sep).option("quote", "").csv(path)


def read_typed_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """CSV with a declared schema; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def parse_checked_csv(lines: DataFrame, names: Sequence[str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Quoted CSV lines to ``(good, rejects)``: a line with another number of fields is a reject."""
    schema = ", ".join(f"`{n}` string" for n in [*names, "_corrupt"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.select(F.col(value).alias("line"), F.from_csv(value, schema, options).alias("r"))
    bad = F.col("r._corrupt").isNotNull() | F.col("r").isNull()
    good = parsed.where(~bad).select(*[F.col(f"r.`{n}`").alias(n) for n in names])
    return good, parsed.where(bad).select("line")


def read_checked_csv(spark: SparkSession, path: str | list[str], names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return parse_checked_csv(spark.read.text(path), names)


def parse_fixed_arity(lines: DataFrame, names: Sequence[str], sep: str = "|", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The first ``len(names)`` fields of each line without commas; shorter lines are rejects."""
    n = len(names)
    cut = lines.select(F.col(value).alias("line"), F.split(F.col(value), f"\\Q{sep}\\E", -1).alias("f"))
    good = cut.where(F.size("f") >= n).select(*[drop_commas(F.get("f", F.lit(i))).alias(c) for i, c in enumerate(names)])
    return good, cut.where(F.size("f") < n).select("line")


def read_fixed_arity(spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str = "|") -> tuple[DataFrame, DataFrame]:
    return parse_fixed_arity(spark.read.text(path), names, sep)


def read_with_header_file(spark: SparkSession, data: str | list[str], header: str, sep: str = ",") -> DataFrame:
    """Column names from the first line of another file; extra fields of a row are dropped."""
    names = spark.read.text(header).first()[0].split(sep)
    return spark.read.schema(_strings(names)).option("sep", sep).option("quote", "").option("enforceSchema", True).csv(data)


def read_profiles(spark: SparkSession, path: str | list[str], mode: str = "quarantine") -> DataFrame:
    """Profile documents, see ``parse_profiles``."""
    return parse_profiles(spark.read.text(path), mode=mode)


def with_file_name(df: DataFrame, out: str = "file_name") -> DataFrame:
    """The file each row came from, so a folder of files is one scan grouped by file.

    Must directly follow the reader.
    """
    return df.select("*", F.col("_metadata.file_name").alias(out))


def file_job_id(name: Column | str) -> Column:
    """Third dash-separated part of a scored file's name."""
    return F.get(F.split(_col(name), "-"), F.lit(2))


def file_label(name: Column | str) -> Column:
    """Everything after the third dash-separated part."""
    parts = F.split(_col(name), "-")
    return F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0))), "-")


def resolve_dated(spark: SparkSession, base: str, pattern: str | None = r"[0-9]{8}", position: int = 0) -> str:
    """Path of the newest (or n-th newest) entry of a folder by name.

    With a pattern only folders whose whole name matches count; without one every entry does.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if pattern is None or (entry.isDirectory() and jvm.java.util.regex.Pattern.matches(pattern, name)):
            found.append((name, entry.getPath().toString()))
    found.sort(reverse=True)
    if len(found) <= position:
        raise FileNotFoundError(f"{base} has {len(found)} dated entries, number {position} was asked for")
    return found[position][1]


def latest_partition(df: DataFrame, dt: str) -> DataFrame:
    """Rows of the newest partition.

    The value is found first, by an aggregate over ``dt``: the scan is pruned to it where ``dt`` is a partition column. Of
    dated folders ``resolve_dated`` finds the newest by listing, without reading any.
    """
    return df.where(F.col(dt) == df.agg(F.max(dt)).scalar())


def nth_partition(df: DataFrame, dt: str, position: int) -> DataFrame:
    """Rows of the n-th newest partition, counted from zero."""
    wanted = df.select(dt).distinct().orderBy(F.col(dt).desc()).offset(position).limit(1)
    return df.where(F.col(dt) == wanted.scalar())


def partition_boundary(names: DataFrame, col: str, base: str) -> DataFrame:
    """Earliest month among dated names such as ``base-2016-05``, as the first day of that month."""
    month = F.regexp_extract(F.min(F.when(F.col(col).startswith(f"{base}-"), F.col(col))), r"-(\d{4}-\d{2})", 1)
    return names.agg(F.to_date(F.concat(month, F.lit("-01"))).alias("boundary"))


#: Members of a job document that are read, unless the caller gives another schema.
HISTORY_SCHEMA = (
    "id string, job_submission struct<selection: struct<segment: string>>, "
    "export_submission struct<base_uri: string>"
)


def read_history(spark: SparkSession, path: str, schema: str = HISTORY_SCHEMA) -> DataFrame:
    """Job documents of a JSON array with their place in it."""
    docs = spark.read.option("multiLine", True).schema(schema).json(path)
    return docs.withColumn("pos", F.monotonically_increasing_id())


def select_jobs(history: DataFrame, jobs: DataFrame, order: str = "pos", job: str = "id") -> DataFrame:
    """Listed jobs as ``label, base_uri``; the label is ``id-segment`` and the last document of a label wins."""
    listed = history.join(jobs.select(F.col(job).alias("id")).distinct(), "id", "left_semi")
    flat = listed.select(
        F.concat_ws("-", "id", "job_submission.selection.segment").alias("label"),
        F.col("export_submission.base_uri").alias("base_uri"),
        order,
    )
    return flat.groupBy("label").agg(F.max_by("base_uri", order).alias("base_uri"))


OBJECT_HOST = "s3.amazonaws.com"  # fixed value


def split_object_uri(uri: Column | str, host: str = OBJECT_HOST) -> Column:
    """Struct of ``bucket, path`` from ``bucket.host/path`` or ``host/bucket/path``; an empty bucket is an error."""
    u = _col(uri)
    name, path = F.parse_url(u, F.lit("HOST")), F.regexp_replace(F.parse_url(u, F.lit("PATH")), "^/", "")
    in_path = name == host
    parts = F.split(path, "/", 2)
    bucket = F.when(in_path, F.get(parts, F.lit(0))).otherwise(F.regexp_replace(name, f"\\Q.{host}\\E$", ""))
    rest = F.when(in_path, F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).otherwise(path)
    fail = F.raise_error(F.concat(F.lit("empty bucket: "), u)).cast("string")
    return F.struct(F.when(F.coalesce(bucket, F.lit("")) == "", fail).otherwise(bucket).alias("bucket"), rest.alias("path"))


def _bare(path: Column) -> Column:
    """A path without its scheme, as files and labels are compared."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(path), path), "^[a-z0-9]+:/*", "/")


def read_named(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Lines of many named files or folders in one distributed scan: ``name, value``.

    A label stands for the file at its path or for all files below it. Every file is labelled once, by its own path
    and those above it; a label without a file is an error.
    """
    where = F.col("_metadata.file_path")
    labels = spark.createDataFrame(list(paths.items()), "name string, path string").select("name", F.regexp_replace(_bare(F.col("path")), "/+$", "").alias("at"))
    folders = {p.rstrip("/") + "/" for p in paths.values()}
    roots = sorted({p for p in paths.values() if not any(p.startswith(f) and p.rstrip("/") + "/" != f for f in folders)})  # each file once
    read = spark.read.option("recursiveFileLookup", True)
    files = read.format("binaryFile").load(roots).select(where.alias("file"))  # lists the files, reads none
    steps = F.split(_bare(F.col("file")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    labelled = durable(files.distinct().select("file", F.explode(above).alias("at")).join(labels, "at").select("file", "name"))
    lost = [r["name"] for r in labels.select("name").join(labelled, "name", "left_anti").collect()]
    if lost:
        raise FileNotFoundError(f"no file for {', '.join(sorted(lost))}")
    lines = read.text(roots).select("value", where.alias("file"))
    return lines.join(small_side(labelled), "file").select("name", "value")
