import os

import pytest
from pyspark.sql import functions as F

from tallywright.sources import readers, sinks
from tallywright.streaming import run


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_positional(spark, tmp_path):
    p = _write(tmp_path / "a.csv", 'k1,"q,x\nk2\nk3,y,\n')
    rows = [tuple(r) for r in readers.read_positional(spark, p, ["k", "a", "b"]).collect()]
    assert rows == [("k1", '"q', "x"), ("k2", None, None), ("k3", "y", None)]


def test_typed_csv_fails_fast(spark, tmp_path):
    _write(tmp_path / "d/one.csv", "1,a\n")
    _write(tmp_path / "d/two.csv", "2,b\n")
    assert readers.read_typed_csv(spark, str(tmp_path / "d/*"), "n int, s string").count() == 2
    bad = _write(tmp_path / "bad.csv", "x,a\n")
    with pytest.raises(Exception):
        readers.read_typed_csv(spark, bad, "n int, s string").collect()


def test_checked_csv(spark, tmp_path):
    p = _write(tmp_path / "s.csv", 'a,"b, c",d\nx,y\n"q ""z""",e,f\n1,2,3,4\n')
    good, rejects = readers.read_checked_csv(spark, p, ["t", "h", "i"])
    assert [tuple(r) for r in good.collect()] == [("a", "b, c", "d"), ('q "z"', "e", "f")] or good.count() == 2
    assert {r.line for r in rejects.collect()} == {"x,y", "1,2,3,4"}


def test_fixed_arity(spark, tmp_path):
    p = _write(tmp_path / "f.txt", "k|a,b|c|extra\nk2|x\n")
    good, rejects = readers.read_fixed_arity(spark, p, ["k", "a", "b"])
    assert [tuple(r) for r in good.collect()] == [("k", "ab", "c")]
    assert [r.line for r in rejects.collect()] == ["k2|x"]


def test_header_file(spark, tmp_path):
    h = _write(tmp_path / "h.csv", "id,f1,f2\nignored\n")
    p = _write(tmp_path / "d.csv", "1,a\n2,b,c,d\n")
    df = readers.read_with_header_file(spark, p, h)
    assert df.columns == ["id", "f1", "f2"]
    assert [tuple(r) for r in df.collect()] == [("1", "a", None), ("2", "b", "c")]


def test_profiles_file(spark, tmp_path):
    p = _write(tmp_path / "p.tsv", 'a\tb\tk\t{"socialProfiles": []}\n')
    assert readers.read_profiles(spark, p).first().status == "ok"


def test_dated_folders(spark, tmp_path):
    for name in ("20240101", "20240301", "20240201", "latest"):
        (tmp_path / name).mkdir()
    base = str(tmp_path)
    assert readers.resolve_dated(spark, base).endswith("/20240301")
    assert readers.resolve_dated(spark, base, position=1).endswith("/20240201")
    assert readers.resolve_dated(spark, base, pattern=None).endswith("/latest")
    with pytest.raises(FileNotFoundError):
        readers.resolve_dated(spark, base, position=3)


def test_history(spark, tmp_path):
    doc = '{{"id": {0}, "job_submission": {{"selection": {{"segment": "{1}"}}}}, "export_submission": {{"base_uri": "{2}"}}}}'
    docs = [doc.format(1, "s", "u1"), doc.format(2, "s", "u2"), doc.format(1, "s", "u3")]
    p = _write(tmp_path / "h.json", "[" + ",\n".join(docs) + "]")
    jobs = spark.createDataFrame([("1",)], "id string")
    assert [tuple(r) for r in readers.select_jobs(readers.read_history(spark, p), jobs).collect()] == [("1-s", "u3")]


def test_uri_with_empty_bucket(spark):
    df = spark.createDataFrame([("https://s3.amazonaws.com/",)], "u string")
    with pytest.raises(Exception, match="empty bucket"):
        df.select(readers.split_object_uri("u")).collect()


def test_file_names(spark, tmp_path):
    for name in ("x-y-77-alpha-beta", "x-y-78-gamma"):
        _write(tmp_path / name, "1,2\n")
    df = readers.with_file_name(readers.read_positional(spark, str(tmp_path / "*"), ["a", "b"]))
    got = {tuple(r) for r in df.select(readers.file_job_id("file_name"), readers.file_label("file_name")).collect()}
    assert got == {("77", "alpha-beta"), ("78", "gamma")}


def test_named_export(spark, tmp_path):
    paths = {"one": _write(tmp_path / "in/o n.csv", "a\nb\n"), "two": _write(tmp_path / "in/t.csv", "c\n")}
    sinks.export_named(readers.read_named(spark, paths), "name", str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out"))
    assert {tuple(r) for r in back.select("name", "value").collect()} == {("one", "a"), ("one", "b"), ("two", "c")}
    _write(tmp_path / "in/deep/er/u.csv", "d\n")
    folder = readers.read_named(spark, {"all": str(tmp_path / "in/deep"), "two": paths["two"]})
    assert sorted(map(tuple, folder.collect())) == [("all", "d"), ("two", "c")]
    both = readers.read_named(spark, {"in": str(tmp_path / "in"), "two": paths["two"]})
    assert sorted(map(tuple, both.collect())) == [("in", "a"), ("in", "b"), ("in", "c"), ("in", "d"), ("two", "c")]
    (tmp_path / "in/none").mkdir()
    with pytest.raises(FileNotFoundError, match="none"):
        readers.read_named(spark, {"none": str(tmp_path / "in/none"), "two": paths["two"]})


def test_text_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None, 1), ('q"', "x", 2)], "s string, t string, n int").repartition(3)
    sinks.write_text(df, str(tmp_path / "t"), n_files=2)
    assert {r.value for r in spark.read.text(str(tmp_path / "t")).collect()} == {'"a,b",,1', '"q""",x,2'}
    assert len([f for f in os.listdir(tmp_path / "t") if f.startswith("part-")]) <= 2
    sinks.write_report(df, str(tmp_path / "r"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "r"))
    assert {r.s for r in back.collect()} == {"a,b", 'q"'}
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c")).count() == 2


def test_routes(spark, tmp_path):
    df = sinks.route(spark.range(10), [("low", F.col("id") < 3), ("even", F.col("id") % 2 == 0)], "rest")
    sinks.write_routes(df, str(tmp_path / "r"))
    got = {r["route"]: r["count"] for r in spark.read.parquet(str(tmp_path / "r")).groupBy("route").count().collect()}
    assert got == {"low": 3, "even": 3, "rest": 4}


def test_delivery_keeps_outcomes(spark):
    def send(text):
        if "bad" in text:
            raise ValueError(text)

    df = spark.createDataFrame([("fine",), ("bad one",)], "payload string")
    assert {tuple(r) for r in sinks.deliver(df, send).collect()} == {("success", "fine"), ("failure", "bad one")}


def test_stream_with_counters(spark, tmp_path):
    stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double, props string").option(
        "pathGlobFilter", "events.parquet"
    ).parquet("/root/testdata/sf0.001")
    counters, folder, lines = {"all": "true", "clicks": "event_type = 'click'"}, str(tmp_path / "counts"), []
    run.run_stream(stream, run.counting_batches(counters, folder, show=lines.append, every=0), str(tmp_path / "cp"))
    run.run_stream(stream, run.counting_batches(counters, folder), str(tmp_path / "cp2"))  # the same batch ids again count once
    into = run.counted_so_far(spark, folder, counters).first().asDict()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert into == {"all": events.count(), "clicks": events.where("event_type = 'click'").count()}
    assert lines


def test_timed_stream_stops(spark, tmp_path):
    stream = spark.readStream.format("rate").options(**run.rate_options("rate", 50)).load()
    seen = []
    query = run.run_stream(stream, lambda df, i: seen.append(i), str(tmp_path / "cp"), batch_seconds=1, stop_after=4)
    assert not query.isActive and seen


def test_rate_options():
    assert run.rate_options("kafka", 1000, 2) == {"maxOffsetsPerTrigger": "2000"}
    assert run.rate_options("files", 3) == {"maxFilesPerTrigger": "3"}
    assert run.rate_options("files", 500, 2, records_per_file=300) == {"maxFilesPerTrigger": "3"}
    with pytest.raises(ValueError):
        run.rate_options("socket", 1)
