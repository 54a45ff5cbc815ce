"""The pipeline: registered queries, and every stage against a plain version on its own input."""

import math
from collections import Counter, defaultdict

import fixtures as fx
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from tallywright.llm import tokens


@pytest.fixture(scope="module")
def docs(spark):
    return fx.frame(spark, fx.rows(7, 120), extra=False).cache()


def data(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_quality_stage(spark, docs):
    got = data(cp.quality_rules(spark, docs, ""))
    fine = [r for r in data(docs) if fx.measures(r[1])[0] >= 20 and 100 * fx.measures(r[1])[4] <= 30 * fx.measures(r[1])[0]]
    assert Counter(got) == Counter(r for r in fine if fx.measures(r[1])[2] == 0)


def one_of_each(rows):
    """The least row of each group, and all rows without words."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    sets = {i: fx.shingles(rows[i][1], 5) for i in order}
    root = {i: i for i in order}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(order):
        for j in order[:x]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((order.index(find(i)), order.index(find(j))))
                root[order[b]] = order[a]
    return [[i for i in order if find(i) == r] for r in order if find(r) == r]


def test_near_stage(spark, docs):
    got = Counter(data(cp.near_duplicates(spark, docs, "")))
    rows = data(docs)
    groups = one_of_each(rows)
    assert sum(got.values()) == len(groups)
    for g in groups:  # of rows with one doc_id any may stay
        assert any(got[rows[i]] and rows[i][0] == rows[g[0]][0] for i in g)


def test_near_stage_with_unfit_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1), (1, base + " x", "en", "a", 2), (2, base + " y", "en", "a", 3), (1, "another text of six words", "en", "a", 4),
        (None, "lost and found and lost again", "en", "a", 5), (None, "lost and found and lost again", "de", "b", 5), (None, "", "en", "a", 0), (None, None, "en", "a", 0),
        (1, base, "en", "a", 1),
    ]
    got = data(cp.near_duplicates(spark, spark.createDataFrame(rows, fx.SCHEMA), ""))
    assert sorted(str(r[1]) for r in got if r[0] is None) == ["", "None", "lost and found and lost again"]
    assert len([r for r in got if r[1] and r[1].startswith(base)]) == 1 and len(got) == 5


def test_repeats_stage(spark, docs):
    got = cp.repeated_passages(spark, docs, "").collect()
    want = fx.without_repeats(list(dict.fromkeys(data(docs))))
    assert {r.doc_id for r in got} == {d for d, (n, gone, *_) in want.items() if gone < n or n == 0}
    assert all(r.n_chars == len(r.text) and len(r.text.encode()) <= want[r.doc_id][0] - want[r.doc_id][1] for r in got)


def test_mix_stage(spark, docs):
    rows = data(docs)
    got = Counter(data(cp.source_mix(spark, docs, "")))
    own, want = fx.mix_targets(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r, n in zip(rows, fx.sizes(rows), strict=True):
        largest[r[3]] = max(largest[r[3]], n)
    for r, n in got.items():
        assert r in rows and n <= 2 * rows.count(r)
        taken[r[3]] += n * len(fx.WORD.findall(r[1]))
    assert all(math.isclose(taken[s], want[s], abs_tol=2 * largest[s]) for s in own)  # the last document is taken whole or not


def test_whole(spark):
    folder = "/root/testdata/sf0.001"
    rows = cp.run(spark, folder).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    assert rows and all(sum(n for _, n in v) <= 2048 for v in by.values())
    assert [n for n, _ in cp.STAGES][0] == "quality rules" and len(cp.STAGES) == 5


@pytest.mark.parametrize("name", sorted(entry.MORE))
def test_registered(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    sql = entry.oracle_sql().get(name)
    if sql:
        from compare import differences

        assert differences(df, sql, "/root/testdata/sf0.001") is None
    else:
        assert df.count() > 0


def test_packed_ids(spark):
    folder = "/root/testdata/sf0.001"
    own = tokens.pieces(None).own
    from test_operators import packs

    ids = [(r.doc_id, [*own.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    packs(entry.queries()["op7_best_fit_packing"](spark, folder).collect(), ids, 2048)
