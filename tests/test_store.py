"""Stored tables: keyed upserts that survive a break, layouts that prune, deliveries that are not repeated."""

import pytest
from pyspark.sql import functions as F

from tallywright.operators import audience, identity
from tallywright.sources import exports, readers, sinks
from tallywright.sources.keyed import KeyedTable

SCHEMA = "id long, labels array<string>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(spark, tmp_path, buckets=8):
    return KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=buckets)


def held(store):
    return {r.id: r.labels for r in store.read().collect()}


def test_upsert_keeps_other_rows(spark, tmp_path):
    store = keyed(spark, tmp_path)
    assert held(store) == {} and store.of(spark.range(3)).count() == 0
    store.upsert(spark.createDataFrame([(i, [f"l{i}"]) for i in range(50)], SCHEMA))
    change = spark.createDataFrame([(3, ["new"]), (100, ["more"])], SCHEMA)
    for _ in range(2):
        store.upsert(change)
        assert held(store) == {i: [f"l{i}"] for i in range(50)} | {3: ["new"], 100: ["more"]}
    store.upsert(change.where("false"))
    assert held(keyed(spark, tmp_path))[100] == ["more"]


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = keyed(spark, tmp_path)
    store.upsert(spark.createDataFrame([(i, ["x"]) for i in range(100)], SCHEMA))
    stamps = lambda: {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in (tmp_path / "t").glob("_bucket=*/*.parquet")}
    before = stamps()
    store.upsert(spark.createDataFrame([(5, ["y"])], SCHEMA))
    after = stamps()
    assert len(before.keys() - after.keys()) == 1 and len(after.keys() - before.keys()) == 1
    found = store.of(spark.createDataFrame([(5,)], "id long"))
    assert "PartitionFilters: [isnotnull(_bucket" in plan(found) or "PartitionFilters: [(_bucket" in plan(found)
    assert [tuple(r) for r in found.collect()] == [(5, ["y"])]


def test_a_broken_upsert_is_finished_by_the_next_user(spark, tmp_path, monkeypatch):
    store = keyed(spark, tmp_path, 2)
    store.upsert(spark.createDataFrame([(i, ["x"]) for i in range(20)], SCHEMA))

    def lost(self, staged):
        for f in (tmp_path / "t").glob("_bucket=*/*.parquet"):  # some old buckets are gone, no new one is in place
            f.unlink()
            break
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_replace", lost)
        with pytest.raises(RuntimeError):
            store.upsert(spark.createDataFrame([(i, ["y"]) for i in range(5)], SCHEMA))
    spark.catalog.clearCache()
    assert held(keyed(spark, tmp_path, 2)) == {i: ["y"] if i < 5 else ["x"] for i in range(20)}
    assert not (tmp_path / "t/_pending").exists()


def test_labels_and_tags_in_a_store(spark, tmp_path):
    store = keyed(spark, tmp_path)
    store.upsert(spark.createDataFrame([(1, ["b"]), (2, [])], SCHEMA))
    codes = spark.createDataFrame([("1", "a"), ("2", "b")], "code string, label string")
    incoming = spark.createDataFrame([(1, "1"), (1, "2"), (3, "2")], "id long, code string")
    for _ in range(2):
        written = audience.store_merged(store, incoming, codes)
        assert audience.merge_counts(written).first().asDict() == {"total_records": 2, "total_labels": 3}
        assert held(store) == {1: ["a", "b"], 2: [], 3: ["b"]}
    audience.store_tag(store, spark.createDataFrame([(2,), (9,)], "id long"), "t", tags="labels")
    assert held(store) == {1: ["a", "b"], 2: ["t"], 3: ["b"]}


def test_cells_are_pruned_by_attribute(spark, tmp_path):
    cells = spark.createDataFrame([(i, f"a{i % 3}", i, i) for i in range(30)], "key long, attr string, value long, ts long")
    sinks.write_cells(cells, str(tmp_path / "c"))
    one = identity.scan_cells(spark.read.parquet(str(tmp_path / "c")), "a1")
    assert "PartitionFilters: [isnotnull(attr" in plan(one) and one.count() == 10


def test_dated_folders_are_pruned(spark, tmp_path):
    for day, n in (("20240102", 3), ("20240301", 5), ("20240201", 7)):
        sinks.write_dated(spark.range(n), str(tmp_path / "d"), day)
    assert spark.read.parquet(readers.resolve_dated(spark, str(tmp_path / "d"))).count() == 5
    with pytest.raises(ValueError):
        sinks.write_dated(spark.range(1), str(tmp_path / "d"), "latest")
    spark.range(40).withColumn("dt", F.concat(F.lit("d"), F.col("id") % 4)).write.partitionBy("dt").parquet(str(tmp_path / "p"))
    newest = readers.latest_partition(spark.read.parquet(str(tmp_path / "p")), "dt")
    assert newest.count() == 10 and "PartitionFilters: [isnotnull(dt" in plan(newest)


def test_delivery_is_not_repeated(spark, tmp_path):
    sent = str(tmp_path / "sent")

    def send(text):
        with open(sent, "a") as f:
            f.write(text + "\n")
        if text == "bad" and open(sent).read().count("bad") == 1:
            raise ValueError(text)

    ledger = str(tmp_path / "ledger")
    df = spark.createDataFrame([("a",), ("bad",), ("a",), (None,)], "payload string")
    assert sorted(map(tuple, sinks.deliver_once(df, send, ledger).collect())) == [("failure", "bad"), ("success", "a")]
    more = df.union(spark.createDataFrame([("c",)], "payload string"))
    assert sorted(map(tuple, sinks.deliver_once(more, send, ledger).collect())) == [("success", "bad"), ("success", "c")]
    assert sinks.deliver_once(more, send, ledger).count() == 0
    assert sorted(open(sent).read().split()) == ["a", "bad", "bad", "c"]


def test_unknown_job_is_an_error(spark):
    history = spark.createDataFrame([], f"{readers.HISTORY_SCHEMA}, pos long")
    with pytest.raises(LookupError, match="j9"):
        exports.job_paths(history, spark.createDataFrame([("j9",)], "id string"), "/none")
