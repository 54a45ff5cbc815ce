import math

import pytest

from tallywright.operators import drift


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_pair_sets_ignore_duplicates(spark):
    old = _pairs(spark, [("a", "1"), ("a", "1"), ("b", "1"), ("c", "1")])
    new = _pairs(spark, [("a", "1"), ("b", "2"), ("d", "1")])
    got = {r.k: r.status for r in drift.drift_pairs(old, new, "k", "v").collect()}
    assert got == {"a": "constant", "b": "changed", "c": "deleted", "d": "added"}
    summary = {r.status: r.n for r in drift.drift_pairs_summary(old, new, "k", "v").collect()}
    assert summary == {"added": 1, "deleted": 1, "constant": 1, "changed": 1}


def test_distribution_zero_over_zero_and_first_value(spark):
    s = "k string, n double, o int"
    old = spark.createDataFrame([("a", 0.0, 1), ("b", 0.0, 1), ("c", 4.0, 2), ("c", 8.0, 1)], s)
    new = spark.createDataFrame([("a", 0.0, 1), ("b", 3.0, 1), ("c", 6.0, 1)], s)
    got = {r.k: r for r in drift.drift_distribution(old, new, "k", "n", order="o").collect()}
    assert math.isnan(got["a"].pct) and got["b"].pct == math.inf
    assert (got["c"].old_count, got["c"].pct, got["c"].abs_pct) == (8.0, -25.0, 25.0)
    assert drift.drift_distribution(old, new, "k", "n").where("k = 'c'").first().old_count == 4.0


def test_records_are_multisets(spark):
    s = "k string, x string, y string"
    old = spark.createDataFrame([("a", "1", "1"), ("a", "2", "2"), ("b", "1", "1"), ("b", "1", "1"), ("c", "1", None)], s)
    new = spark.createDataFrame([("a", "2", "2"), ("a", "1", "1"), ("b", "1", "1"), ("c", "1", None)], s)
    got = {r.k: r.status for r in drift.drift_records(old, new, "k").collect()}
    assert got == {"a": "constant", "b": "changed", "c": "constant"}


def test_field_rules(spark):
    s = "id string, f string, g string, h string, raw1 string, raw2 string"
    old = spark.createDataFrame([("1", "A", None, "x", "Y", "N"), ("2", "A", "", "x", "Y", "N"), ("3", "A", "q", "x", "Y", "N")], s)
    new = spark.createDataFrame([("1", "B", "", "y", "N", "N"), ("2", "A", "", "x", "Y", "Y"), ("3", "A", None, "x", "Y", "Y")], s)
    d = spark.createDataFrame(
        [("Field F", "f", "A", "is A", "Demog"), ("Field G", "g", "q", "is q", "Demog"), ("Both", "h", "-", "-", "Demog"), ("Raw", "raw1", "Y", "yes", "Other")],
        "title string, field string, value string, value_name string, category string",
    )
    got = {tuple(r) for r in drift.drift_fields(old, new, "id", d, expand={"h": ["raw1", "raw2"]}).collect()}
    # 1: f changed to an unlabelled code; g missing and blank are both unknown; h expands to the raw flag
    # 2: an old blank is not the same as unknown; h itself is unchanged, so its flags are not reported
    # 3: g is missing in the new record, so it is not looked at
    assert got == {("1", "Field F", "is A", "Unk"), ("1", "raw1", "Y", "N"), ("2", "Field G", "Unk", "Unk")}
    counts = {tuple(r) for r in drift.transition_counts(old, new, "id", d, expand={"h": ["raw1", "raw2"]}).collect()}
    assert counts == {("Field F", "is A", "Unk", 1), ("raw1", "Y", "N", 1), ("Field G", "Unk", "Unk", 1)}


def test_regression_flags_growth_only(spark):
    old, new = spark.range(10).toDF("x"), spark.range(20).toDF("x")
    out = drift.regression_check(old, new, [("x >= 0", 99.9), ("x >= 0", 100.0), ("x > 50", 0.0), ("x = 15", 5.0), ("x < 5", 10.0)])
    rows = {(r.predicate, r.allowed_pct): (r.old_count, r.new_count, r.flagged) for r in out.collect()}
    assert rows[("x >= 0", 99.9)] == (10, 20, True) and rows[("x >= 0", 100.0)] == (10, 20, False)
    assert rows[("x > 50", 0.0)] == (0, 0, False) and rows[("x = 15", 5.0)] == (0, 1, True)


def test_empty_records_use_the_declared_last_column(spark):
    cur = spark.createDataFrame([("1", "", None, "z"), ("2", "a", "", ""), ("3", "", "", "")], "id string, a string, b string, z string")
    assert {r.id for r in drift.empty_records(cur, "id").collect()} == {"1", "3"}
    assert {r.id for r in drift.nonempty_records(cur, "id").collect()} == {"2"}
    prev = spark.createDataFrame([("1", "x", "", ""), ("3", "", "", "")], "id string, a string, b string, z string")
    assert {r.id for r in drift.newly_empty(cur, prev, "id").collect()} == {"1"}


@pytest.mark.parametrize("parts", [1, 7])
def test_result_does_not_depend_on_partitions(spark, parts):
    old = spark.range(500).selectExpr("cast(id % 50 as string) k", "cast(id % 7 as string) v").repartition(parts)
    new = spark.range(400).selectExpr("cast(id % 60 as string) k", "cast(id % 5 as string) v").repartition(parts)
    assert sorted(tuple(r) for r in drift.drift_pairs_summary(old, new, "k", "v").collect()) == [
        ("added", 10), ("changed", 50), ("constant", 0), ("deleted", 0)
    ]
