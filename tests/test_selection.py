"""The highest rows of each group against a plain sort."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallywright.operators import scoring, selection
from tallywright.plans import score_plans

SCHEMA = "g string, id long, score double"


def table(seed, many=600):
    rng = random.Random(seed)
    shapes = [
        lambda: rng.gauss(0, 1), lambda: float(rng.randint(-3, 3)), lambda: 10 ** rng.uniform(-300, 300), lambda: 7.0,
        lambda: rng.choice([math.inf, -math.inf, 0.0, 5e-324, 1.7e308, -1.7e308]), lambda: 1.0 + rng.randint(0, 3) * 2**-52,
    ]
    return [(None if i % 7 == 6 else f"g{i % 7}", i, shapes[i % 7 % len(shapes)]()) for i in range(many)]


def plain(rows, goals):
    by = defaultdict(list)
    for g, i, s in rows:
        by[g].append((-s, i))
    return {(g, i): r for g, k in goals.items() for r, (_, i) in enumerate(sorted(by[g])[: max(0, k)], 1)}


@pytest.mark.parametrize(("bins", "edge"), [(1024, 100_000), (4, 1), (2, 5), (64, 10)])
@pytest.mark.parametrize("seed", [1, 2])
def test_highest_rows_of_each_group(spark, monkeypatch, bins, edge, seed):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "EDGE", edge)
    rows = table(seed)
    goals = {"g0": 17, "g1": 40, "g2": 1, "g3": 33, "g4": 50, "g5": 20, None: 1000, "absent": 4}
    if seed == 2:
        goals |= {"g0": 0, "g1": -2, "g2": 86}
        goals.pop("g3")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = spark.createDataFrame(list(goals.items()), "g string, k long")
    got = selection.highest(df, "score", ["id"], wanted, ["g"]).collect()
    want = plain(rows, goals)
    assert {(r.g, r.id): r["rank"] for r in got} == want and len(got) == len(want)
    bare = selection.highest(df, "score", ["id"], wanted, ["g"], with_rank=False)
    assert bare.columns == df.columns
    assert sorted((r.g or "", r.id) for r in bare.collect()) == sorted((g or "", i) for g, i in want)


def test_without_groups_and_without_rows(spark, monkeypatch):
    monkeypatch.setattr(selection, "EDGE", 3)
    rows = table(3)
    df = spark.createDataFrame(rows, SCHEMA)
    goal = spark.createDataFrame([(100,)], "k long")
    got = selection.highest(df, "score", ["id"], goal, with_rank=False).collect()
    assert {r.id for r in got} == {i for _, i in sorted((-s, i) for _, i, s in rows)[:100]} and len(got) == 100
    assert selection.highest(df.where("false"), "score", ["id"], goal).count() == 0
    assert selection.highest(df, "score", ["id"], goal.where("false")).count() == 0


def test_few_rows_are_sorted(spark, monkeypatch):
    """Only rows of the range that holds the last wanted one meet the range exchange of the sort."""
    monkeypatch.setattr(selection, "EDGE", 20)
    sorted_rows = []
    real = selection.global_rank

    def watching(df, order, groups, **names):
        sorted_rows.append(df.count())
        return real(df, order, groups, **names)

    monkeypatch.setattr(selection, "global_rank", watching)
    data = score_plans.scored(spark, "/root/testdata/sf0.01")
    choice = data.select("file").distinct().withColumn("deciles", 1 + F.length("file") % 3)
    files = choice.count()
    picked = scoring.top_deciles(data, "score", ["id"], choice=choice, group_cols=["file"], with_rank=False)
    assert len(sorted_rows) == 1 and sorted_rows[0] <= 20 * files < data.count() / 10
    assert picked.count() > sorted_rows[0]
