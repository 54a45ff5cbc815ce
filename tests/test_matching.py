import json
import random
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from tallywright.functions.similarity import jaro_winkler
from tallywright.operators import matching


def _words(seed, n, alphabet, longest):
    pick = random.Random(seed)
    out = set()
    while len(out) < n:
        out.add("".join(pick.choice(alphabet) for _ in range(pick.randint(1, longest))))
    return sorted(out)


def _all_pairs(a, b, threshold):
    frame = pd.DataFrame([(x, y) for x in a for y in b], columns=["a", "b"])
    frame["s"] = np.concatenate(
        [np.round(jaro_winkler(list(c.a), list(c.b)), 6) for c in (frame[i : i + 4096] for i in range(0, len(frame), 4096))]
    )
    kept = frame[frame.s > threshold]
    return set(zip(kept.a, kept.b, kept.s))


def test_similarity_agrees_with_duckdb():
    a = _words(1, 3000, "abcde #", 14)
    b = [x[: random.Random(x).randint(0, 4)] + y for x, y in zip(a, _words(2, 3000, "abcdex", 12))]
    pairs = pd.DataFrame({"a": a, "b": b, "i": range(len(a))})
    con = duckdb.connect()
    con.register("pairs", pairs)
    want = [r[0] for r in con.execute("SELECT round(jaro_winkler_similarity(a, b), 6) FROM pairs ORDER BY i").fetchall()]
    assert np.allclose(np.round(jaro_winkler(a, b), 6), want, atol=1e-9)


def test_known_values():
    got = np.round(jaro_winkler(["martha", "dixon", "abc", ""], ["marhta", "dicksonx", "xyz", "a"]), 6)
    assert list(got) == [0.961111, 0.813333, 0.0, 0.0]


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.93])
def test_no_pair_is_lost(spark, threshold):
    a, b = _words(3, 250, "abcdefgh_", 12), _words(4, 250, "abcdefgh_", 16)
    left = spark.createDataFrame([(x,) for x in a], "text string")
    right = spark.createDataFrame([(x,) for x in b], "text string")
    got = [tuple(r) for r in matching.similar_texts(left, right, threshold).collect()]
    assert len(got) == len(set(got))
    assert {(x, y, round(s, 6)) for x, y, s in got} == {(x, y, round(s, 6)) for x, y, s in _all_pairs(a, b, threshold)}


def test_rare_characters_and_splits(spark, monkeypatch):
    """Few characters with a bit of their own, and every key split, must give the same pairs."""
    monkeypatch.setattr(matching, "WORD_BITS", 3)
    monkeypatch.setattr(matching, "WORDS", 2)
    monkeypatch.setattr(matching, "ROWS_PER_SPLIT", 20)
    a, b = _words(5, 150, "abcdefghijké", 9), _words(6, 150, "abcdefghijké", 9)
    left = spark.createDataFrame([(x,) for x in a], "text string")
    right = spark.createDataFrame([(x,) for x in b], "text string")
    got = {(r.a, r.b, round(r.similarity, 6)) for r in matching.similar_texts(left, right).collect()}
    assert got == {(x, y, round(s, 6)) for x, y, s in _all_pairs(a, b, 0.8)}


def test_no_cross_join(spark):
    texts = spark.createDataFrame([("abc",), ("abd",)], "text string")
    plan = matching.similar_texts(texts, texts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_match_rules(spark):
    titles = spark.createDataFrame([('The "Big" Cat', "pets"), ("zzzz", "none")], "title string, category string")
    handles = spark.createDataFrame([("thebigcat", None, "x"), ("other", "The Big Cät", "y")], "handle string, name string, category string")
    got = {(r.title, r.handle, r.name, r.squish) for r in matching.fuzzy_match(titles, handles).collect()}
    assert got == {("The Big Cat", "thebigcat", "Not Defined", True), ("The Big Cat", "other", "The Big Ct", False)}


def test_copies_of_a_text(tmp_path):
    """However many texts share a character, a text goes to few places: few records a text are shuffled."""
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config(
    "spark.eventLog.enabled", "true").config("spark.eventLog.dir", {tmp_path.as_uri()!r}).config("spark.eventLog.compress", "false").config(
    "spark.eventLog.rolling.enabled", "false").getOrCreate()
from tallywright.operators import matching
left, right = (spark.range(n).select(F.format_string(f, "id").alias("text")) for n, f in ((50, "supplier#%09d"), (5000, "customer#%09d")))
print("rows", matching.similar_texts(left, right).count())
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=False)
    assert "rows" in done.stdout, done.stderr[-2000:]
    records = 0
    for line in next(x for x in tmp_path.iterdir() if x.is_file()).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            records += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    assert 5050 <= records < 8 * 5050


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_anagrams_and_long_texts(spark, threshold):
    """Groups of many texts, crossed characters and texts of any length are bounded without losing a pair."""
    pick = random.Random(9)
    a = ["supplier#" + "".join(pick.sample("00012345", 8)) for _ in range(120)] + ["é" * 90, "x" * 70 + "ab", "a一b", "ab", "\U0001f600a"]
    b = ["customer#" + "".join(pick.sample("00012345", 8)) for _ in range(120)] + ["é" * 80 + "x", "x" * 69 + "ba", "b一a", "ba", "\U0001f600b"]
    left = spark.createDataFrame([(x,) for x in [*a, None, ""]], "text string")
    right = spark.createDataFrame([(x,) for x in [*b, None, ""]], "text string")
    got = [(r.a, r.b, round(r.similarity, 6)) for r in matching.similar_texts(left, right, threshold).collect()]
    assert sorted(got) == sorted((x, y, round(s, 6)) for x, y, s in _all_pairs(sorted(set(a)), sorted(set(b)), threshold))
