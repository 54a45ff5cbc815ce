"""Extra columns of the caller with the names that operators use inside."""

from collections import Counter

import fixtures as fx
from pyspark.sql import functions as F

from tallywright.llm import licenses, mixing

DATA = fx.rows()
MIX = ["_s", "_last", "_cut", "_epochs", "_key", "_part", "part", "s", "epochs", "budget", "last_part", "room", "sum", "cut", "weight", "_row.x", "SIZE", "target"]
SCAN = ["own", "folder", "near", "_key", "_folder", "up", "of_up", "line", "b", "tokens", "k", "run", "held", "doc_id", "Score"]


def marked(df, names):
    return df.select("*", *[F.lit(n).alias(n) for n in names])


def test_mix_keeps_the_columns_of_the_caller(spark):
    docs = fx.frame(spark, DATA, extra=False)
    plain = mixing.mixed(docs).select("doc_id", "copies", "taken", "target")
    got = mixing.mixed(marked(docs, MIX))
    assert got.columns == [*docs.columns, *[n for n in MIX if n not in ("SIZE", "target")], "size", "source_size", "target", "quality", "copies", "taken"]
    assert Counter(map(tuple, got.select("doc_id", "copies", "taken", "target").collect())) == Counter(map(tuple, plain.collect()))
    own = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(MIX) if n not in ("SIZE", "target")]
    assert {tuple(r) for r in got.select(*own).collect()} == {tuple(n for n in MIX if n not in ("SIZE", "target"))}


def test_scan_keeps_the_columns_of_the_caller(spark):
    files = spark.createDataFrame(
        [("a/LICENSE", "Released under the MIT License."), ("a/b.txt", "words"), (None, None), ("a/b.txt", "words"), ("c", "")], "path string, text string"
    )
    plain = licenses.scanned(files)
    got = licenses.scanned(marked(files, SCAN))
    assert got.columns == ["path", *[n for n in SCAN if n != "Score"], *plain.columns[1:]]
    assert Counter(map(tuple, got.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert {tuple(r) for r in got.select(*[n for n in SCAN if n != "Score"]).collect()} == {tuple(n for n in SCAN if n != "Score")}
