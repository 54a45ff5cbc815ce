"""A stored table with one row per key, kept in key buckets and changed bucket by bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import durable

BUCKET = "_bucket"


class KeyedTable:
    """Rows of ``schema`` with the unique column ``key`` under ``path``, in ``buckets`` folders by a hash of the key.

    ``upsert`` replaces the rows of the given keys and leaves all others as they are; only buckets that hold one of the
    keys are read and written. The new buckets are written to the shared folder first and the table's ``_pending`` note
    names them, until they have replaced the old ones. Whoever opens the table next finishes an upsert that was broken off, so
    a rerun is harmless. One writer at a time. ``buckets`` stays the same for the life of the table; a bucket should fit a task.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "id", buckets: int = 256):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self._finish()

    def _files(self, name: str = ""):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}{name}")
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def _exists(self, name: str = "") -> bool:
        fs, at = self._files(name)
        return fs.exists(at)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _replace(self, staged: str) -> None:
        """Put staged buckets in the place of the old ones; doing it again changes nothing."""
        rows = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(staged)
        by_bucket = rows.repartition(BUCKET)
        by_bucket.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def _finish(self) -> None:
        if self._exists("/_pending/_SUCCESS"):
            self._replace(self.spark.read.text(f"{self.path}/_pending").first()[0])
            fs, at = self._files("/_pending")
            fs.delete(at, True)

    def rows(self) -> DataFrame:
        """All rows, with their bucket."""
        schema = f"{self.schema}, {BUCKET} int"
        if not self._exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self.rows().drop(BUCKET)

    def _touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the given keys, ``buckets`` of them at most."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def of(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; folders of other buckets are not read."""
        held = self.rows().where(F.col(BUCKET).isin(self._touched(keys)))
        return held.join(keys.select(self.key).distinct(), self.key, "left_semi").drop(BUCKET)

    def upsert(self, changed: DataFrame) -> None:
        """Replace or add the rows of ``changed``, which holds a key once."""
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        fresh = durable(changed.select(*names).withColumn(BUCKET, self.bucket()))
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        if not touched:
            return
        other = self.rows().where(F.col(BUCKET).isin(touched)).join(fresh.select(self.key), self.key, "left_anti")
        staged = durable(other.unionByName(fresh)).inputFiles()[0].rsplit("/", 1)[0]
        self.spark.createDataFrame([(staged,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/_pending")
        self._finish()
