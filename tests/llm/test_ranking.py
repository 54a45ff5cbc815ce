"""Ranked search, SentencePiece symbols and importance resampling against plain versions of their rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import fixtures as fx
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywright.llm import importance, queries, ranked, symbols

DATA = fx.rows()
#: Names these operators use inside, as extra columns of the caller.
NAMES = "item term bit times salt terms weights block shard first rank score at words n_features weight bucket ids decoded agrees df w".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def clashing(df):
    return df.select("*", *[F.lit("x").alias(n) for n in NAMES if n not in df.columns])


def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_search(docs, items, k):
    bags = [(d, Counter(search_terms(t)), len(search_terms(t))) for d, t in docs]
    n, terms = sum(m > 0 for *_, m in bags), sum(m for *_, m in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in set(items):
        scores = []
        for d, b, m in bags:
            s = 0
            for t, times in Counter(search_terms(text)).items():
                if t in b:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += times * w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * (25 + (75 * m * n) // terms)))
            if s > 0:
                scores.append((-s, d is None, d))
        for r, (s, lost, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out[item, r, d, -s] += 1
    return out


def items_frame(spark, rows):
    return clashing(spark.createDataFrame(rows, "item_id long, text string")).repartition(3)


ITEMS = [
    (1, DATA[4][1]), (2, DATA[9][1]), (2, DATA[9][1]), (2, "one Two three"), (3, None), (4, ""), (5, "nowhere-at-all"), (None, "日本語 é ab"),
    (6, "ab " * 50), (7, DATA[1][1] + " " + DATA[3][1]), (8, "x" * 5000),
]


@pytest.mark.parametrize(("leaf", "wave", "shard", "asked"), [(48, 32, 1_000_000, 500_000), (1, 2, 400, 60), (5, 1, 2000, 500_000)])
def test_ranked_search(spark, monkeypatch, leaf, wave, shard, asked):
    for name, value in (("LEAF", leaf), ("WAVE", wave), ("SHARD", shard), ("ASKED", asked), ("FIRST", 3)):
        monkeypatch.setattr(ranked, name, value)
    docs = [(d, t) for d, t, *_ in DATA] + [(None, DATA[4][1]), (None, "ab")]
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(4)
    got = Counter(tuple(r) for r in ranked.ranked(frame, items_frame(spark, ITEMS), k=4).collect())
    assert got == plain_search(docs, ITEMS, 4)


def test_ranked_search_among_copies(spark):
    docs = [(i, "common words of a large group") for i in range(3000)] + [(5000 + i, f"common w{i}") for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = ranked.ranked(frame, spark.createDataFrame([(1, "large group"), (2, "common"), (3, "w7 w9")], "item_id long, text string"))
    rows = sorted(tuple(r)[:3] for r in got.collect())
    want = [(1, i + 1, i) for i in range(10)] + [(3, 1, 5007), (3, 2, 5009)]
    assert [r for r in rows if r[0] != 2] == want  # a term of every document has weight 0


def test_ranked_search_of_nothing(spark):
    docs, items = fx.frame(spark, []), items_frame(spark, [])
    assert ranked.ranked(docs, items_frame(spark, ITEMS)).count() == 0
    assert ranked.ranked(fx.frame(spark, DATA), items).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.data())
def test_range_maxima(values, data):
    x = np.array(values)
    table = ranked._argmax_table(x, len(x))
    a = data.draw(st.integers(0, len(x) - 1))
    e = data.draw(st.integers(a + 1, len(x)))
    j = int(ranked.Shard._level(np.array(e - a)))
    assert max(x[table[j, a]], x[table[j, e - (1 << j)]]) == x[a:e].max()


@pytest.fixture(scope="module")
def model():
    return symbols.vocabulary()


def ids_of(model, text):
    return np.frombuffer(model.encode(text), np.int32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁\n\tthe ing<>s0x41/"), st.characters(exclude_categories=["Cs"]))))
def test_symbols_are_those_of_the_library(model, text):
    ids = ids_of(model, text)
    assert ids == model.library.encode(text)
    assert model.decode(ids) == model.library.decode(ids) == text.replace("▁", " ")


def test_any_ids_decode_as_the_library_does(model):
    rng = random.Random(1)
    pools = [[0, 1, 2], range(3, 259), range(259, len(model.surface)), [model.id["▁"], model.id["▁▁"], model.id["▁the"]]]
    for _ in range(3000):
        ids = [rng.choice(rng.choice(pools)) for _ in range(rng.randrange(7))]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_merging_does_not_depend_on_words(model, monkeypatch):
    texts = [t or "" for _, t, *_ in DATA]
    by_run = [model.encode(t) for t in texts]
    monkeypatch.setattr(model, "by_run", False)
    assert [model.encode(t) for t in texts] == by_run
    monkeypatch.setattr(model, "by_word", False)
    assert [model.encode(t) for t in texts] == by_run
    assert [model._long(list(t)) for t in texts] == [model._short(list(t)) for t in texts]


def test_a_wrong_run_is_told(monkeypatch):
    own = symbols.Vocabulary()
    right = own.merged
    monkeypatch.setattr(own, "merged", lambda w: list(w) if "thing" in w else right(w))
    texts = ["a thing.", "", "another word", "some things"]
    for t in texts:
        own.encode(t)
    assert own.check(texts) == [False, True, True, False]
    own.encode("thing")
    assert own.check(["a thing", "fine"]) == [False, True]


def test_sentencepiece(spark, model, monkeypatch):
    monkeypatch.setattr(symbols, "CHARS_AT_ONCE", 3000)
    data = DATA + [(7000, "no spaces in " + "這是一個很長的句子" * 800, None, None, None), (None, "▁ a  b ", None, None, None)]
    rows = symbols.encoded(clashing(fx.frame(spark, data))).collect()
    want = Counter((d, tuple(model.library.encode(t or "")), (t or "").replace("▁", " ")) for d, t, *_ in data)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == want
    assert all(r.agrees for r in rows)
    assert symbols.encoded(fx.frame(spark, [])).count() == 0


def test_sentencepiece_query(spark, model):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = {r.doc_id: model.library.encode(r.text or "") for r in texts}
    want = {(d, len(i), digest(",".join(map(str, i))), digest(model.library.decode(i)), True) for d, i in ids.items()}
    assert {tuple(r) for r in queries.op12_sentencepiece(spark, folder).collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=200), min_size=1, max_size=20))
def test_checksums(spans):
    data = b"".join(spans)
    stop = np.cumsum([len(s) for s in spans])
    start = stop - [len(s) for s in spans]
    got = importance.checksums(np.frombuffer(data, np.uint8), start, stop)
    assert got.tolist() == [zlib.crc32(s) for s in spans]


@pytest.mark.parametrize("size", [31, 32, 33, 64, 65, 1000, 100_003])
def test_checksums_of_long_spans(size):
    data = random.Random(size).randbytes(size + 3)
    got = importance.checksums(np.frombuffer(data, np.uint8), np.array([0, 1, 2]), np.array([size, size + 1, 3]))
    assert got.tolist() == [zlib.crc32(data[:size]), zlib.crc32(data[1 : size + 1]), zlib.crc32(data[2:3])]


def plain_features(text, width):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return [" ".join(w[i : i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]


def plain_resample(docs, target, width, buckets, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    feats = [[bucket(f) for f in plain_features(t, width)] for _, t in docs]
    s = Counter(b for f in feats for b in f)
    t = Counter(bucket(f) for x in target for f in plain_features(x, width))
    up, down = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * up / ((s[b] + 1) * down)))
    rows = []
    for (d, text), f in zip(docs, feats, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(f), weight, score, len(plain_features(text, 1))))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    return Counter([(*r[:4], i if i <= drawn else None) for i, r in enumerate(able, 1)] + [(*r[:4], None) for r in rows if r[4] < 20])


@pytest.mark.parametrize(("width", "buckets", "percent"), [(1, 10_000, 10), (2, 97, 60), (3, 1, 100)])
def test_importance_resampling(spark, width, buckets, percent):
    docs = [(d, t) for d, t, *_ in DATA] + [(None, DATA[4][1]), (None, None)]
    target = [DATA[4][1], DATA[9][1], None, ""]
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(4)
    goal = clashing(spark.createDataFrame([(t,) for t in target], "text string"))
    got = importance.resampled(frame, goal, width, buckets, percent=percent)
    assert Counter(tuple(r) for r in got.collect()) == plain_resample(docs, target, width, buckets, percent)


def test_importance_resampling_of_nothing(spark):
    none, some = fx.frame(spark, []), fx.frame(spark, DATA)
    assert importance.resampled(none, some).count() == 0
    got = importance.resampled(some, none.select("text")).collect()
    assert Counter(tuple(r) for r in got) == plain_resample([(d, t) for d, t, *_ in DATA], [], 1, 10_000, 10)
