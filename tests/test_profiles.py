import pytest

from tallywright.operators import profiles

LINES = [
    'a\tb\tk1\t{"socialProfiles": [{"type": "twitter", "username": "@Ann", "id": "1"}, {"type": "web"}, 5, {"username": "x"}]}',
    'a\tb\tk2\t{"socialProfiles": []}',
    'a\tb\tk3\t{"other": []}',
    'a\tb\tk4\t{"socialProfiles": "text"}',
    'a\tb\tk5\t[1, 2]',
    "a\tb\tk6\tnot json",
    "too\tshort",
    'a\tb\tk7\t{"socialProfiles": [{"type": "twitter"}, {"type": "twitter", "username": "not a handle"}, {"type": "twitter", "id": "7"}]}',
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_status(lines):
    got = [r.status for r in profiles.parse_profiles(lines).collect()]
    assert got == ["ok", "ok", "no_profiles", "no_profiles", "bad_json", "bad_json", "bad_line", "ok"]


def test_strict_mode_raises(lines):
    with pytest.raises(Exception, match="not a JSON object"):
        profiles.parse_profiles(lines, mode="strict").collect()


def test_tokens(lines):
    got = {r.token: r.n for r in profiles.profile_token_counts(profiles.parse_profiles(lines)).collect()}
    assert got == {
        "records": 8, "twitter": 4, "web": 1, "NONE": 1, "NONE-twitter": 1, "NONE-web": 1, "twitter-web": 1,
        "has_twitter": 2, "has_web": 1, "has_NONE": 1, "no-sp": 2,
    }
    pct = {r.token: r.pct for r in profiles.token_percent(profiles.profile_token_counts(profiles.parse_profiles(lines))).collect()}
    assert pct == {"per_has_twitter": 25.0, "per_has_web": 12.5, "per_has_NONE": 12.5}


def test_extract(lines):
    parsed = profiles.parse_profiles(lines)
    got = sorted(tuple(r) for r in profiles.extract_profiles(parsed, "twitter").collect())
    assert got == [("k1", "ann", "1"), ("k2", "", ""), ("k7", "", ""), ("k7", "", "7")]
    lenient = sorted(tuple(r) for r in profiles.extract_profiles(parsed, "twitter", lenient=True).collect())
    assert lenient == [("k1", "@ann", "1"), ("k7", "", ""), ("k7", "", "7"), ("k7", "not a handle", "")]


def test_counters(lines):
    got = {r.counter: r.n for r in profiles.profile_counters(profiles.parse_profiles(lines), "twitter").collect()}
    assert got == {
        "records": 8, "no_profiles": 2, "of_type": 4, "other_type": 3, "tuples": 3,
        "with_0": 1, "with_1": 1, "with_2": 1, "with_n": 0, "no_id": 1,
    }


def test_members_that_are_not_text(spark):
    lines = spark.createDataFrame(
        [('a\tb\tk\t{"socialProfiles": [{"type": "twitter", "username": 5, "id": "1"}, {"type": 3}]}',)], "value string"
    )
    parsed = profiles.parse_profiles(lines)
    assert [tuple(r) for r in profiles.extract_profiles(parsed, "twitter").collect()] == [("k", "", "1")]
    assert {r.token for r in profiles.profile_token_counts(parsed).collect()} == {"records"}
    with pytest.raises(Exception, match="username is not a string"):
        profiles.extract_profiles(parsed, "twitter", strict=True).collect()
    with pytest.raises(Exception, match="type is not a string"):
        profiles.profile_token_counts(parsed, strict=True).collect()


def test_dictionary(spark):
    docs = spark.createDataFrame(
        [('{"f": {"name": "my_field", "title": "T", "displayable": null, "category": null, "children": null, "datasource": "partner1", "list": [{"title": " One ", "value": 1}]}}',)],
        "value string",
    )
    rows = {(r.title, r.field, r.value, r.value_name, r.displayable, r.category) for r in profiles.flatten_dictionary(docs, "partner1").collect()}
    assert rows == {
        ("My field", "f", "1", "One", False, "Indiv"),
        ("State", "state", "state", "state", True, "Geo"),
        ("Metro Area", "metro_area", "metro_area", "metro_area", True, "Geo"),
    }
