"""From a job history to one folder of lines per exported label."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .readers import read_named, select_jobs, split_object_uri
from .sinks import export_named

#: Labels of one export; their names and paths pass through the driver.
MOST_LABELS = 10_000


def job_paths(history: DataFrame, jobs: DataFrame, root: str) -> dict[str, str]:
    """Where the lines of each label of the listed jobs lie: ``root/bucket/path``.

    A job without a document is an error, and so are more than ``MOST_LABELS`` labels.
    """
    lost = jobs.select("id").distinct().join(history, "id", "left_anti").limit(5).collect()
    if lost:
        raise LookupError(f"no job document for {', '.join(str(r.id) for r in lost)}")
    at = split_object_uri("base_uri")
    found = select_jobs(history, jobs).select("label", at.getField("bucket").alias("b"), at.getField("path").alias("p")).limit(MOST_LABELS + 1).collect()
    if len(found) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels in one export")
    return {r.label: f"{root.rstrip('/')}/{r.b}/{r.p}" for r in found}


def export_jobs(history: DataFrame, jobs: DataFrame, root: str, out: str, mode: str = "errorifexists") -> None:
    """Copy the lines of every label of ``jobs(id)`` to ``out/name=<label>``, in one scan over all of them."""
    paths = job_paths(history, jobs, root)
    if paths:
        export_named(read_named(history.sparkSession, paths), "name", out, mode)
