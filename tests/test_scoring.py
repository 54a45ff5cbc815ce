import pytest
from pyspark.sql import functions as F

from tallywright.functions import exprs
from tallywright.operators import histogram, rank, scoring


def _scores(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, score double")


def test_rounding(spark):
    df = _scores(spark, [-2.5, 2.5, -0.5, 0.49, -387.0, 387.0])
    r = exprs.jround("score")
    got = [tuple(x) for x in df.select(r, exprs.trunc_to(r, 100)).collect()]
    assert got == [(-2, 0), (3, 0), (0, 0), (0, 0), (-387, -300), (387, 300)]


def test_zero_joins_the_zero_bound_or_the_overflow(spark):
    df = _scores(spark, [-3, 0, 0, 1, 5, 9])
    by = {r.label: r.n for r in histogram.histogram(df, "score", (0, 5)).collect()}
    assert by == {"(-inf, 0]": 3, "(0, 5)": 1, "[5, inf)": 2}
    by = {r.label: r.n for r in histogram.histogram(df, "score", (1, 5)).collect()}
    assert by == {"(-inf, 1)": 1, "[1, 5)": 1, "[5, inf)": 4}


def test_negative_buckets_are_closed_on_the_right(spark):
    df = _scores(spark, [-12, -10, -7, -5, -1])
    by = {r.label: r.n for r in histogram.histogram(df, "score", (-10, -5, 0)).collect()}
    assert by == {"(-inf, -10]": 2, "(-10, -5]": 2, "(-5, 0]": 1, "(0, inf)": 0}


def test_signed_histogram_with_one_bound_per_side(spark):
    rows = histogram.histogram_signed(_scores(spark, [-4, 0, 3, 3]), "score", 100).collect()
    assert {(r.side, r.lower, r.upper, r.n) for r in rows} == {(-1, None, -1, 1), (0, 0, 0, 1), (1, 1, None, 2)}


def test_signed_histogram_lists_empty_buckets(spark):
    rows = histogram.histogram_signed(_scores(spark, [-25, 1, 31]), "score", 10).collect()
    got = {(r.side, r.step): (r.lower, r.upper, r.n) for r in rows}
    assert got[(-1, 0)] == (-10, -1, 0) and got[(-1, 1)] == (-20, -11, 0) and got[(-1, 2)] == (None, -21, 1)
    assert got[(1, 0)] == (1, 10, 1) and got[(1, 1)] == (11, 20, 0) and got[(1, 3)] == (31, None, 1)


def test_cumulative_overflow(spark):
    df = _scores(spark, [-5, 1, 5, 7, 20])
    n = lambda **kw: [r.n for r in histogram.cumulative_distribution(df, "score", (5, 10), **kw).orderBy("pos").collect()]
    assert n() == [3, 4, 1]
    assert n(compat=True) == [3, 4, 5]
    assert n(complementary=True) == [4, 2, 1]
    assert n(complementary=True, compat=True) == [4, 2, 2]


def test_deciles_need_ten_positive_scores(spark):
    with pytest.raises(Exception, match="fewer than ten"):
        scoring.chunk_bounds(_scores(spark, range(-5, 9)), "score", ["id"]).collect()


def test_chunks_cover_all_scores(spark):
    df = _scores(spark, [*range(1, 26), -1, -2, -3])
    rows = scoring.chunk_bounds(df, "score", ["id"]).orderBy("chunk").collect()
    assert [(r.max_score, r.min_score, r.n) for r in rows[:2]] == [(25.0, 24.0, 2), (23.0, 22.0, 2)]
    assert len(rows) == 14 and sum(r.n for r in rows) == 28


def test_top_deciles_break_ties_by_id(spark):
    df = _scores(spark, [7] * 30)
    assert sorted(r.id for r in scoring.top_deciles(df, "score", ["id"], deciles=2).collect()) == [0, 1, 2, 3, 4, 5]


def test_a_group_without_choice_is_an_error(spark):
    df = spark.range(40).selectExpr("id", "1.0D + id as score", "concat('f', id % 2) as file")
    choice = spark.createDataFrame([("f0", 1)], "file string, deciles int")
    with pytest.raises(Exception, match="no number of deciles"):
        scoring.top_deciles(df, "score", ["id"], choice=choice, group_cols=["file"]).collect()


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_rank_of_one_hot_score(spark, parts):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 1, id) as score", "id % 4 as g").repartition(parts)
    got = {r.id: r.rank for r in rank.global_rank(df, [F.desc("score"), F.asc("id")]).collect()}
    rows = sorted(((1 if i % 3 == 0 else i), i) for i in range(5000))
    want = {i: n for n, (_, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), start=1)}
    assert got == want
    per_group = rank.global_rank(df, [F.desc("score"), F.asc("id")], ["g"]).groupBy("g").agg(F.max("rank"), F.count_distinct("rank"))
    assert {tuple(r) for r in per_group.collect()} == {(g, 1250, 1250) for g in range(4)}


def test_rank_with_a_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    assert {(r.id, r.rank) for r in rank.global_rank(df, [F.asc("id")], ["g"]).collect()} == {(1, 1), (2, 2), (3, 1)}


def test_rank_keeps_the_data_spread(spark):
    df = spark.range(1000).repartition(4).withColumn("g", F.col("id") % 3)
    for groups in ((), ("g",)):
        plan = rank.global_rank(df, [F.asc("id")], groups)._jdf.queryExecution().executedPlan().toString()
        moves = [line for line in plan.splitlines() if "Exchange" in line]
        # only the stored offsets, few rows for each partition, are sent; the sorted data stays where it is
        assert len(moves) == 1 and "BroadcastExchange" in moves[0]


def test_sample_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as double) as score")
    out = scoring.sample_per_group(df, "score", [F.asc("id")])
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 30


def test_unmatched_id_gives_null(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, score double")
    ids = spark.createDataFrame([(1, 77)], "id int, sid int")
    got = {r.id: r.profile_url for r in scoring.left_enrich(rows, ids, "id", "sid").collect()}
    assert got[2] is None and got[1].endswith("=77")


def test_batches(spark):
    out = rank.batch_keys(spark.range(7).toDF("k"), "k", [F.asc("k")], 3).orderBy("batch").collect()
    assert [(r.batch_name, list(r["keys"])) for r in out] == [
        ("batch-000000000", [0, 1, 2]), ("batch-000000001", [3, 4, 5]), ("batch-000000002", [6])
    ]


def test_report_per_file_is_the_report_of_each_file(spark):
    df = spark.range(300).selectExpr("id", "cast((id * 7919) % 1000 - 300 as double) as score", "concat('f', id % 3) as file")
    df = df.unionByName(spark.createDataFrame([(900, 5.0, "g")], "id long, score double, file string"))
    both = scoring.analysis_report(df, "score", ["file"]).collect()
    for name in ("f0", "f1", "f2"):
        alone = {r.pos: (r.value, r.share) for r in scoring.analysis_report(df.where(F.col("file") == name), "score").collect()}
        assert {r.pos: (r.value, r.share) for r in both if r.file == name} == alone
    assert {r.metric: r.value for r in both if r.file == "g"}["Standard Deviation + Mean Count"] == 0.0
    kept = {r.id for r in scoring.above_mean_plus_sd(df, "score", ["file"]).where("file = 'f1'").collect()}
    assert kept == {r.id for r in scoring.above_mean_plus_sd(df.where("file = 'f1'"), "score").collect()}


def test_more_than_ten_chunks_reach_negative_scores(spark):
    df = _scores(spark, [*range(1, 21), -1, -2, -3, -4])
    picked = {d: sorted(r.score for r in scoring.top_deciles(df, "score", ["id"], deciles=d).collect()) for d in (1, 10, 11)}
    assert picked[1] == [19.0, 20.0] and picked[10] == [float(i) for i in range(1, 21)]
    assert picked[11] == [-2.0, -1.0, *[float(i) for i in range(1, 21)]]
