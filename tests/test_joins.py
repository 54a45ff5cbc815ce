import pytest
from pyspark.sql import functions as F

from tallywright import runtime
from tallywright.functions import exprs
from tallywright.operators import appending, audience, crosswalk, identity, rules
from tallywright.sources import seeds


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_common_keys_ignore_nulls(spark):
    a = spark.createDataFrame([("1", "x"), ("1", "x"), (None, "y"), ("2", None)], "k string, s string")
    b = spark.createDataFrame([("1", "x"), (None, "y"), ("2", None)], "q string, s string")
    assert _rows(crosswalk.common_keys(a, b, [("k", "q")])) == [("1",), ("2",)]
    assert _rows(crosswalk.common_keys(a, b, [("k", "q"), ("s", "s")])) == [("1", "x")]
    counts = dict(_rows(crosswalk.population_counts(a, {"k": ["k"], "pair": ["k", "s"]})))
    assert counts == {"k": 3, "pair": 3}


def test_best_partner(spark):
    a = spark.createDataFrame([("L1", "e1", "t1"), ("L1", "e2", "t2"), ("L2", "e2", "t2"), ("L3", "e9", "t9")], "link string, email string, tw string")
    b = spark.createDataFrame([("P5", "e1", "t1"), ("P7", "e1", "t1"), ("P5", "e2", "t2"), ("P1", "e9", "t1")], "partner string, emd string, tw string")
    best = crosswalk.crosswalk_best(a, b, [("email", "emd"), ("tw", "tw")], "link", "partner", ["email"])
    assert _rows(best) == [("L1", "P5", "e1"), ("L2", "P5", "e2")]
    scored = spark.createDataFrame([("P5", 9.0), ("P5", 9.0)], "partner string, score double")
    assert _rows(crosswalk.attach_scores(best, scored, "partner", ["link", "email", "score"])) == [("L1", "e1", 9.0), ("L2", "e2", 9.0)]


def test_append_takes_the_first_rows(spark):
    base = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c"), ("3", "d")], "id string, name string")
    mid = spark.createDataFrame([("1", "m2", "k1", 2), ("1", "m1", "k2", 1), ("2", "m3", "k9", 1), ("9", "m4", "k1", 1)], "mid string, m string, mk string, o int")
    app = spark.createDataFrame([("k2", "z", 2), ("k2", "y", 1), ("k1", "x", 1)], "ak string, a string, o int")
    out = appending.append_two_stage(
        base, mid, app, base_id="id", base_cols=["name"], base_order=["name"], mid_id="mid", mid_key="mk",
        mid_cols=["m"], mid_order=["o"], app_key="ak", app_cols=["a"], app_order=["o"],
    )
    assert _rows(out) == [("1", "a", "y", "m1"), ("2", "c", "", "m3"), ("3", "d", "", "")]
    counts = dict(_rows(appending.append_match_counts(base, mid, app, base_id="id", mid_id="mid", mid_key="mk", app_key="ak")))
    assert counts == {"only_mid": 1, "only_base": 1}


def test_index_list_is_bounded(spark):
    lines = spark.createDataFrame([("x,0",)] * 4, "value string")
    with pytest.raises(ValueError, match="more column indexes"):
        appending.index_list(lines, 3)


def test_cells(spark):
    cells = spark.createDataFrame(
        [("a", "id", "1", 1), ("a", "id", "2", 2), ("b", "id", "2", 1), ("c", "id", "3", 1), ("a", "tags", "9", 1)],
        "key string, attr string, value string, ts int",
    )
    assert _rows(identity.dump_lookup(cells, "id")) == [("a", "1"), ("b", "2"), ("c", "3")]
    assert [tuple(r) for r in identity.duplicate_ids(cells, "id").collect()] == [("2", "a", 2), ("2", "b", 1)]
    assert _rows(identity.recycled_ids(cells, "id")) == [("a", "1", 1, 2), ("a", "2", 2, 2)]
    assert identity.recycled_counts(cells, "id").first().asDict() == {"records": 3, "hits": 1}


def test_activity(spark):
    cells = spark.createDataFrame(
        [("f", "follow", "5", "2020-01-02"), ("f", "follow", "0", "2020-01-01"), ("g", "follow", "1", "2020-01-01"),
         ("t", "tweet", "x", "2020-01-01"), ("t", "tweet", "y", "2024-06-01"), ("u", "tweet", "x", "2024-06-01"), ("v", "tag", "good", "2020-01-01")],
        "key string, attr string, value string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    keys = spark.createDataFrame([(k,) for k in "fgtuvw"], "key string")
    roles = {"followers": "follow", "tweets": "tweet", "tags": "tag", "good_tags": ["good"]}
    active = {r.key: r.active for r in identity.qualify_activity(keys, cells, **roles).collect()}
    # f: the earliest count decides, although a later one is higher
    assert active == {"f": False, "g": True, "t": True, "u": False, "v": True, "w": False}
    recent = identity.qualify_activity(keys, cells, now=F.lit("2025-01-01").cast("timestamp"), recent_only=True, **roles)
    assert not {r.key: r.active for r in recent.collect()}["t"]


def test_lookups(spark):
    keys = spark.createDataFrame([("a",), ("z",), ("a",)], "id string")
    table = spark.createDataFrame([("a", "n1", ["p", "q"]), ("b", "n2", ["r"]), ("a", "n3", ["q"])], "id string, name string, tags array<string>")
    assert _rows(identity.lookup_batch(keys, table, "id", ["name"], {"name": "-"})) == [("a", "n1"), ("a", "n3"), ("z", "-")]
    assert _rows(identity.lookup_batch(keys, table, "id", ["name"], keep_missing=False)) == [("a", "n1"), ("a", "n3")]
    plan = identity.lookup_batch(keys, table, "id", ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LeftAnti" in plan  # the table was met once, before; what is missing comes from its rows
    got = {(r.id, r.value) for r in identity.collect_lookup(keys, table, "id", "tags").collect()}
    assert got == {("a", "p"), ("a", "q"), ("z", None)}


def test_audience(spark):
    codes = spark.createDataFrame([("1", "one"), ("2", "two")], "code string, label string")
    incoming = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2")], "id string, code string")
    stored = spark.createDataFrame([("a", "two"), ("a", "old"), ("c", "old")], "id string, label string")
    merged = {r.id: r.labels for r in audience.merge_audiences(stored, incoming, codes).collect()}
    assert merged == {"a": ["old", "one", "two"], "b": ["two"]}
    as_codes = spark.createDataFrame([("b", "1")], "id string, label string")
    merged = {r.id: r.labels for r in audience.merge_audiences(as_codes, incoming, codes, stored_are_codes=True).collect()}
    assert merged["b"] == ["one", "two"]
    with pytest.raises(Exception, match="unknown code"):
        audience.map_codes(spark.createDataFrame([("a", "9")], "id string, code string"), codes).collect()
    assert audience.map_codes(spark.createDataFrame([("a", "9")], "id string, code string"), codes, on_missing="drop").count() == 0


def test_tags_and_edges(spark):
    df = spark.createDataFrame([("a", ["x"]), ("b", None), ("c", ["x"])], "id string, tags array<string>")
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    assert {r.id: r.tags for r in audience.add_tag(df, ids, "x").collect()} == {"a": ["x"], "b": ["x"], "c": ["x"]}
    pairs = spark.createDataFrame([("s", "t"), ("s", "u")], "src string, tgt string")
    edges = audience.edge_tombstones(pairs)
    kept, dropped = audience.drop_edges(edges, pairs.where("tgt = 't'"))
    assert (edges.count(), kept.count(), dropped.count()) == (10, 5, 5)


def test_rules(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert sorted(r.x or 0 for r in rules.reject(df, "x > 3").collect()) == [0, 1]
    labels = [r.label for r in rules.classify(df, [("big", "x > 3"), ("any", "x > 0")], "none").collect()]
    assert labels == ["any", "none", "big"]
    names = [n for n, _ in rules.conflict_rules()]
    assert names == [f"code{i}" for i in range(1, 16)]


def test_filters_reach_the_scan(spark):
    from datetime import datetime

    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = rules.search_filter(df, created="ts", at_least=("value", 3.0), between=(datetime(2024, 1, 5), datetime(2024, 1, 9)))
    plan = out.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "GreaterThanOrEqual(value,3.0)" in plan and "props" not in plan


def test_small_side_is_checked(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(runtime.small_side(spark.range(10)))
    assert not hinted(runtime.small_side(spark.range(1000), max_rows=100))
    assert not hinted(runtime.small_side(spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000)), max_chars=5000))


def test_character_references(spark):
    cases = {
        "&eacute;&#233;&#xE9;&#x27;&copy;": "ééé'©", "&apos; &amp &nope; &": "&apos; &amp &nope; &", "&amp;amp;lt;": "&amp;lt;",
        "a&nbsp;b": "a\u00a0b", "&#128512;&#x1F600;": "😀😀", "&#xD800;&#1114112;&#99999999;": "&#xD800;&#1114112;&#99999999;", "": "", "&lt;\n&gt;;": "<\n>;",
    }
    df = spark.createDataFrame([*cases.items(), (None, None)], "text string, want string").select(exprs.html_unescape("text").alias("got"), "want")
    for row in df.collect():
        assert row.got == row.want


def test_expressions(spark):
    one = spark.range(1)
    got = one.select(
        exprs.norm_handle(F.lit(" @Ab_1 ")), exprs.norm_handle(F.lit("no good")), exprs.handle_url(F.lit("no good")),
        exprs.html_unescape(F.lit("&amp;lt; &quot;x&#39;")), exprs.pretty_title(F.lit("a_b c")), exprs.dsl_term(F.lit('text:"x y"')),
        exprs.dsl_term(F.lit("hashtags:z")), exprs.csv_line(F.lit('a"b'), F.lit(None), F.lit("c")), exprs.unquote_number(F.lit('""')),
        exprs.pct_text(F.lit(1), F.lit(3)), exprs.pct_text(F.lit(1), F.lit(0)), exprs.first_non_empty(F.lit(" "), F.lit("v")),
    ).first()
    assert tuple(got) == ("ab_1", None, "https://twitter.com/", "&lt; \"x'", "A b c", "x y", "#z", '"a""b",,c', 0.0, "33.33%", None, "v")
    pct = one.select(exprs.pct_change(F.lit(0), F.lit(0)), exprs.pct_change(F.lit(0), F.lit(-1)), exprs.pct_change(F.lit(8), F.lit(9.0))).first()
    assert str(pct[0]) == "nan" and pct[1] == float("-inf") and pct[2] == 12.5


def test_seed_payload(spark):
    rows = spark.createDataFrame([("", "@Bob", " 7"), ("T", "bad handle", "1")], "title string, handle string, id string")
    assert [r.payload for r in seeds.seed_payload(rows).collect()] == [
        '{"name":"@bob","twitterHandle":"@bob","twitterBio":"","mediaTitle":null,"mediaId":"7"}'
    ]


def test_code_lists_keep_their_rows(spark):
    codes = spark.createDataFrame([("1", "one"), ("2", "two")], "code string, label string")
    rows = spark.createDataFrame([("a", ["1", "2"]), ("a", ["2", "2"]), ("b", []), ("c", ["1", "2"])], "id string, codes array<string>")
    got = sorted((r.id, r.labels) for r in audience.map_code_lists(rows, codes).collect())
    assert got == [("a", ["one", "two"]), ("a", ["two", "two"]), ("b", []), ("c", ["one", "two"])]
    bad = spark.createDataFrame([("a", ["9"])], "id string, codes array<string>")
    with pytest.raises(Exception, match="unknown code"):
        audience.map_code_lists(bad, codes).collect()
    assert audience.map_code_lists(bad, codes, on_missing="drop").first().labels == []
