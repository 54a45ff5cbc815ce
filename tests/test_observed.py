"""Counters made by the job that writes the rows, and totals of streams."""

import pytest
from pyspark.sql import functions as F
from test_profiles import LINES

from tallywright.observed import counted
from tallywright.operators import appending, drift, profiles
from tallywright.plans import append_plans, drift_plans, profile_plans
from tallywright.streaming import run

FOLDER = "/root/testdata/sf0.001"


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan")


def test_counters_belong_to_the_first_action(spark):
    some = counted(spark.range(10), {"all": F.count(F.lit(1)), "low": F.count_if(F.col("id") < 3)})
    assert some.rows.where("id > 5").count() == 4
    assert some.counters() == {"all": 10, "low": 3}
    assert some.rows.count() == 10 and some.counters() == {"all": 10, "low": 3}


@pytest.mark.parametrize("lenient", [False, True])
def test_extraction_and_its_counters_are_one_scan(spark, lenient):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3)
    parsed = profiles.parse_profiles(lines)
    both = profiles.extract_counted(parsed, "twitter", lenient=lenient)
    rows, counters = both.stored()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, profiles.extract_profiles(parsed, "twitter", lenient=lenient).collect()))
    assert list(map(tuple, counters.collect())) == [tuple(r) for r in profiles.profile_counters(parsed, "twitter").collect()]
    events = profiles.extract_counted(profile_plans.parsed(spark, FOLDER), "click").rows
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert scans(events) == 1 and "Exchange" not in plan and "CollectMetrics" in plan


def test_no_lines(spark):
    parsed = profiles.parse_profiles(spark.createDataFrame([], "value string"))
    assert set(profiles.extract_counted(parsed, "x").stored()[1].select("n").distinct().collect()) == {(0,)}
    assert profiles.profile_token_counts(parsed).count() == profiles.profile_pair_counts(parsed).count() == 0


def test_tokens_come_from_few_lists(spark):
    plan = profiles.profile_token_counts(profile_plans.parsed(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate")  # lines are aggregated below the explode


def test_appended_rows_and_counters(spark):
    sides = append_plans.sides(spark, FOLDER)
    both = appending.append_counted(*sides, **append_plans.NAMES)
    plain = appending.append_two_stage(*sides, **append_plans.NAMES)
    assert both.rows.columns == plain.columns
    rows, counters = both.stored()
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    got = dict(map(tuple, counters.collect()))
    assert got["records"] == got["with_mid"] + got["without_mid"] == got["with_app"] + got["without_app"] == plain.count()
    old = {r.counter: r.n for r in append_plans.append_match_counts(spark, FOLDER).collect()}
    assert got["without_mid"] == old["only_base"]


def test_drift_rows_and_counters(spark):
    old, new = (drift_plans.last_orders(x) for x in drift_plans.halves(spark, FOLDER))
    rows, counters = drift.drift_records_counted(old, new, "id").stored()
    assert rows.count() == drift.drift_records(old, new, "id").count()
    assert dict(map(tuple, counters.collect())) == {r.status: r.n for r in drift.drift_records_summary(old, new, "id").collect()}


def parts(spark, folder, n):
    """``n`` files of 10 numbers each, read one file a batch."""
    for i in range(n):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)


def test_totals_survive_a_failure_and_stay_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(run.Ledger, "KEEP", 3)
    counters = {"all": "true", "even": "id % 2 = 0"}
    folder, at = str(tmp_path / "counts"), str(tmp_path / "cp")
    stream = parts(spark, str(tmp_path / "in"), 7)
    read = []

    def each(df, batch):
        df.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch}"))
        read.append(batch)

    def failing(df, batch):
        each(df, batch)
        if batch == 4:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run.run_stream(stream, run.counting_batches(counters, folder, failing), at)
    assert run.counted_so_far(spark, folder, counters).first().asDict() == {"all": 40, "even": 20}  # batches 0 to 3
    run.run_stream(stream, run.counting_batches(counters, folder, each), at)
    assert read == [0, 1, 2, 3, 4, 4, 5, 6]
    assert run.counted_so_far(spark, folder, counters).first().asDict() == {"all": 70, "even": 35}
    ledger = run.Ledger(spark, folder, counters)
    assert ledger._held() == [4, 5, 6]
    assert ledger.add(5, {"all": 1, "even": 0}) == {"all": 51, "even": 25}  # a repeated batch starts from the one before it


def test_no_batches(spark, tmp_path):
    assert run.counted_so_far(spark, str(tmp_path / "none"), ["a", "b"]).first().asDict() == {"a": 0, "b": 0}


def test_progress_is_shown_by_a_listener(spark, tmp_path):
    counters, lines, other = {"all": "true"}, [], []
    ledger = run.Ledger(spark, str(tmp_path / "counts"), counters)
    listeners = [run.Progress(ledger, lines.append, every=0, name="shown"), run.Progress(ledger, other.append, every=0, name="another")]
    for x in listeners:
        spark.streams.addListener(x)
    try:
        run.run_stream(parts(spark, str(tmp_path / "in"), 3), run.counting_batches(counters, str(tmp_path / "counts")), str(tmp_path / "cp"), name="shown")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(100):
            if lines[-1:] == ["all=30"]:
                break
            run.time.sleep(0.1)
    finally:
        for x in listeners:
            spark.streams.removeListener(x)
    assert lines[-1] == "all=30" and not other
