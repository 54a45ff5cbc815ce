"""Results that must not depend on how many lists, codes or deciles there are, or on where Python started."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

from tallywright.operators import audience, overlap, scoring


def table(names):
    rows = [(n, f"v{i % 7}") for i, n in enumerate(names)] + [(n, "all") for n in names]
    return [*rows, ("stranger", "all"), ("stranger", "v1"), (None, "all"), (names[0], None)]


@pytest.mark.parametrize("many", [3, 63, 64, 130])
def test_given_names_only(spark, many):
    names = [f"n{i:03d}" for i in range(many)]
    lists = spark.createDataFrame(table(names), "list_name string, value string")
    got = {(r.list_a, r.list_b): r.n_common for r in overlap.overlap_counts(lists, names).collect()}
    held = {n: {v for m, v in table(names) if m == n and v} for n in names}
    assert got == {(a, b): len(held[a] & held[b]) for a in names for b in names}
    free = {r.list_a for r in overlap.overlap_counts(lists).collect()}
    assert free == {*names, "stranger"}


@pytest.mark.parametrize("many", [3, 63, 64, 130])
def test_ladder_of_given_names(spark, many):
    rungs = [f"n{i:03d}" for i in reversed(range(many))]
    ladder = spark.createDataFrame(table(rungs), "rung_name string, value string")
    base = spark.createDataFrame([("A", "all"), ("A", "v1"), ("B", "all"), (None, "v2"), ("A", "none")], "base_name string, value string")
    got = {(r.base_name, r.rung_name): r.n_new for r in overlap.ladder_counts(base, ladder, ["A"], rungs).collect()}
    held = {n: {v for m, v in table(rungs) if m == n and v} for n in rungs}
    first = Counter(next(n for n in rungs if v in held[n]) for v in ("all", "v1") if any(v in held[n] for n in rungs))
    assert got == {("A", n): first[n] for n in rungs}
    sets = overlap.coverage(base, ladder, ["A"], rungs).collect()
    assert len({(tuple(r.base_set), tuple(r.rung_set)) for r in sets}) == len(sets)


@pytest.mark.parametrize("many", [3, 10_050])
def test_code_lists(spark, many):
    codes = spark.createDataFrame([(str(i), f"L{i}") for i in range(many)] + [(None, "no")], "code string, label string")
    rows = spark.createDataFrame([(1, ["2", "1"]), (2, None), (3, []), (4, ["1", "1"])], "id long, codes array<string>")
    got = {r.id: r.labels for r in audience.map_code_lists(rows, codes).collect()}
    assert got == {1: ["L1", "L2"], 2: None, 3: [], 4: ["L1", "L1"]}
    odd = spark.createDataFrame([(1, ["1", None, "x"])], "id long, codes array<string>")
    assert audience.map_code_lists(odd, codes, on_missing="drop").first().labels == ["L1"]
    with pytest.raises(Exception, match="unknown code"):
        audience.map_code_lists(odd, codes).collect()


@pytest.mark.parametrize("deciles", [10, 11])
def test_rows_without_a_score(spark, deciles):
    rows = [(i, float(i)) for i in range(1, 41)] + [(100, float("nan")), (101, None)]
    df = spark.createDataFrame(rows, "id long, score double")
    got = {r.id for r in scoring.top_deciles(df, "score", ["id"], deciles=deciles).collect()}
    assert got == set(range(1, 41))


def test_package_reaches_the_executors(tmp_path):
    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as entry
print("rows", entry.queries()["fuzzy_match_parties"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert "rows" in done.stdout, done.stderr[-2000:]
