from pyspark.sql import functions as F

from tallywright.operators import overlap


def _lists(spark, data):
    rows = [(n, v) for n, vs in data.items() for v in vs]
    return spark.createDataFrame(rows, "list_name string, value string")


def test_empty_list_has_size_zero_and_null_percent(spark):
    lists = _lists(spark, {"a": ["x", " X ", "y"], "b": ["Y", "", "  "]})
    counts = {(r.list_a, r.list_b): r.n_common for r in overlap.overlap_counts(lists, ["a", "b", "c"]).collect()}
    assert counts[("a", "a")] == 2 and counts[("a", "b")] == 1 and counts[("b", "b")] == 1
    assert counts[("c", "c")] == 0 and counts[("a", "c")] == 0 and len(counts) == 9
    pct = {(r.list_a, r.list_b): r.pct for r in overlap.overlap_percent(lists, ["a", "b", "c"]).collect()}
    assert pct[("c", "a")] is None and pct[("a", "b")] == 50.0


def test_more_lists_than_bits(spark):
    rows = spark.range(80).select(
        F.format_string("list%02d", F.col("id")).alias("list_name"), F.explode(F.sequence(F.lit(0), F.col("id")).cast("array<string>")).alias("value")
    )
    wide = overlap.overlap_counts(rows)
    found = {(r.list_a, r.list_b): r.n_common for r in wide.collect()}
    assert len(found) == 6400
    assert all(n == min(int(a[4:]), int(b[4:])) + 1 for (a, b), n in found.items())


def test_sets_of_many_lists(spark):
    names = [f"list{i:03d}" for i in range(130)]
    data = {n: [str(v) for v in range(400) if (v * 7 + i) % (i + 2) == 0] for i, n in enumerate(names)}
    brute = {}
    for v in map(str, range(400)):
        members = tuple(n for n in names if v in set(data[n]))
        if members:
            brute[members] = brute.get(members, 0) + 1
    lists = _lists(spark, data)
    assert {tuple(r.members): r.n for r in overlap.combinations(lists).collect()} == brute
    turned = {tuple(reversed(m)): n for m, n in brute.items()}
    assert {tuple(r.members): r.n for r in overlap.combinations(lists, names[::-1]).collect()} == turned
    plan = overlap.combinations(lists, names)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "bit_or" in plan
    assert overlap.combinations(lists.limit(0), names).count() == 0


def test_ladder_order_is_the_given_one(spark):
    base = spark.createDataFrame([("b", "1"), ("b", "2"), ("b", "3"), ("b", "3")], "base_name string, value string")
    ladder = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "2"), ("y", "9")], "rung_name string, value string")
    got = {r.rung_name: r.n_new for r in overlap.ladder_counts(base, ladder, rungs=["y", "x", "z"]).collect()}
    assert got == {"y": 1, "x": 1, "z": 0}
    sizes = {r.rung_name: r.size for r in overlap.ladder_sizes(ladder, rungs=["y", "x", "z"]).collect()}
    assert sizes == {"y": 2, "x": 2, "z": 0}
    assert overlap.ladder_totals(base, ladder).first().pct_total == 66.67
    sets = {tuple(r.rung_set): r.n for r in overlap.ladder_powerset(base, ladder, rungs=["y", "x"]).collect()}
    assert sets == {("x",): 1, ("y", "x"): 1}


def test_wide_ladder_agrees_with_the_mask(spark):
    base = spark.range(300).select((F.col("id") % 3).cast("string").alias("base_name"), F.col("id").cast("string").alias("value"))
    ladder = spark.range(900).select(F.format_string("r%02d", F.col("id") % 70).alias("rung_name"), (F.col("id") * 7 % 400).cast("string").alias("value"))
    wide = {(r.base_name, r.rung_name): r.n_new for r in overlap.ladder_counts(base, ladder).collect()}
    brute = {}
    rungs = {}
    for r in ladder.collect():
        rungs.setdefault(r.value, set()).add(r.rung_name)
    for r in base.collect():
        for name in [min(rungs[r.value])] if r.value in rungs else []:
            brute[(r.base_name, name)] = brute.get((r.base_name, name), 0) + 1
    assert {k: v for k, v in wide.items() if v} == brute and len(wide) == 3 * 70
    order = sorted(rungs_of for rungs_of in {r.rung_name for r in ladder.select("rung_name").distinct().collect()})[::-1]
    turned = {(r.base_name, r.rung_name): r.n_new for r in overlap.ladder_counts(base, ladder, rungs=order).collect()}
    brute = {}
    for r in base.collect():
        if r.value in rungs:
            key = (r.base_name, max(rungs[r.value]))
            brute[key] = brute.get(key, 0) + 1
    assert {k: v for k, v in turned.items() if v} == brute


def test_matrix_needs_no_join(spark):
    lists = _lists(spark, {"a": ["x"], "b": ["x"]})
    plan = overlap.overlap_counts(lists, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
