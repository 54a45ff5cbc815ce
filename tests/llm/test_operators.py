"""Each operator against a plain version of its rule, on a table with every awkward row, and on no rows."""

import contextlib
import io
import math
from collections import Counter, defaultdict

import fixtures as fx
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywright import runtime
from tallywright.llm import common, licenses, mixing, near, packing, quality, search, suffix, tokens, toxicity, urls

DATA = fx.rows()
UNIQUE = [r for i, r in enumerate(DATA) if r not in DATA[:i]]


@pytest.fixture(scope="module")
def docs(spark):
    return fx.frame(spark, DATA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return fx.frame(spark, [])


def test_mix(spark, docs):
    got = mixing.mixed(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
    own, want = fx.mix_targets(DATA)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d[0], n) for d, n in zip(DATA, fx.sizes(DATA), strict=True))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == own[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert r.size == 0 or r.copies in (math.floor(r.target / r.source_size + 1e-9), math.floor(r.target / r.source_size + 1e-9) + 1)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in own:
        assert abs(taken[s] - want[s]) <= max(2 * largest[s], 1)
    again = mixing.mixed(docs.repartition(3)).select(*got[0].__fields__).collect()
    assert Counter(again) == Counter(got)


@pytest.mark.parametrize("seed", [2, 3])
def test_mix_is_near_the_target(spark, seed):
    data = [(i, " ".join(["w"] * (1 + i * seed % 50)), "en", f"s{i % 4}" if i % 3 else "hot", None) for i in range(3000)]
    rows = mixing.mixed(fx.frame(spark, data)).groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 25 for r in rows)


def test_bounded_frames(monkeypatch):
    monkeypatch.setattr(common, "CHARS_AT_ONCE", 10)
    frame = pd.DataFrame({"text": ["a" * 4, None, "b" * 5, "c" * 30, "", "d", "e" * 9], "i": range(7)})
    parts = list(common.bounded(iter([frame, frame[:0]])))
    assert pd.concat(parts).equals(frame) and len(parts[-1]) == 0
    sizes = [[len(t or "") for t in p["text"]] for p in parts]
    assert all(sum(n) - max(n, default=0) <= 10 for n in sizes) and len(parts) == 4


def test_repeats(spark, docs):
    got = suffix.without_repeats(docs).collect()
    want = fx.without_repeats(UNIQUE)
    assert len(got) == len(DATA)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r


def test_repeats_of_a_hot_anchor(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", 1)
    want = fx.without_repeats(UNIQUE)
    for r in suffix.without_repeats(docs).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r


def test_repeats_across_segments(monkeypatch):
    text = b"".join(b"%d," % (i * i % 977) for i in range(400))
    whole = {s for a, m, _ in suffix.cells(text) for b, k in zip(a, m, strict=True) for s in range(b, b + k)}
    anchors = lambda: {s: h for a, m, hs in suffix.cells(text) for b, k, h in zip(a, m, hs, strict=True) for s in range(b, b + k)}
    before = anchors()
    monkeypatch.setattr(suffix, "SEGMENT", 150)
    assert whole == set(range(len(text) - 99)) and anchors() == before


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=0, max_size=90))
def test_suffix_array(values):
    s = np.array([*[v + 1 for v in values], 0])
    sa = suffix.suffix_array(s)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    shared = suffix.common_prefixes(s.astype(np.uint8), sa, 12)
    for a, b in zip(sa[:-1], sa[1:], strict=True):
        n = next((i for i in range(12) if max(a, b) + i >= len(s) or s[a + i] != s[b + i]), 12)
        assert shared[b] == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=6), st.integers(2, 6))
def test_repeated_windows(texts, window):
    cells, seen = [t.encode() for t in texts], set()
    for cell, found in zip(cells, suffix.repeated_windows(cells, window) if cells else [], strict=True):
        want = []
        for i in range(len(cell) - window + 1):
            want += [i] if cell[i : i + window] in seen else []
            seen.add(cell[i : i + window])
        assert found.tolist() == want


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100), (2, 1, 2)])
def test_near(spark, docs, k, num, den):
    got = near.near_duplicates(docs, k, num, den).collect()
    assert Counter(map(tuple, got)) == fx.near_groups(DATA, k, num, den)


def test_near_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "OFTEN", 2)
    got = near.near_duplicates(docs, 4, 60, 100).collect()
    assert Counter(map(tuple, got)) == fx.near_groups(DATA, 4, 60, 100)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=12), min_size=2, max_size=40), st.integers(1, 10), st.booleans())
def test_tree_connects_what_links_connect(sets, num, two):
    arrays = [np.sort(np.array(list(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in sets]
    half = len(sets) // 2 if two else len(sets)
    found = near.spanning_links(arrays[:half], arrays[half:] if two else None, num, 10)

    def groups(links):
        root = list(range(len(sets)))
        for a, b in links:
            old, new = root[a], root[b]
            root = [new if r == old else r for r in root]
        return {frozenset(i for i in range(len(sets)) if root[i] == r) for r in root}

    all_ = [(a, b) for a in range(len(sets)) for b in range(a) if 10 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and (not two or b < half <= a)]
    assert groups(found) == groups(all_)


def test_tokens(spark, docs):
    own = tokens.pieces(None).own
    want = Counter()
    for d, t, *_ in DATA:
        n = len(own.encode(t or "", add_special_tokens=False).ids)
        want[(d, len((t or "").encode()), n, n > 2048)] += 1
    assert Counter(map(tuple, tokens.token_counts(docs).collect())) == want


def test_rare_pre_tokens(spark, docs, monkeypatch):
    want = Counter(map(tuple, tokens.token_counts(docs).collect()))
    monkeypatch.setattr(tokens, "HEAD", 5)
    assert Counter(map(tuple, tokens.token_counts(docs).collect())) == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    own = tokens.pieces(None)
    assert np.frombuffer(own.ids(text), "<u4").tolist() == own.own.encode(text, add_special_tokens=False).ids


def packs(rows, ids, room):
    """Every piece of every document once, with its digest, and sequences without gap or overflow."""
    want = Counter()
    for d, all_ in ids:
        for p, at in enumerate(range(0, len(all_), room)):
            want[(d, p, at, len(all_[at : at + room]), fx.crc(all_[at : at + room]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(by)


@pytest.mark.parametrize("room", [2048, 64])
def test_packing(spark, docs, room):
    own = tokens.pieces(None).own
    ids = [(d, [*own.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, *_ in DATA]
    used = packs(packing.packed(docs, room).collect(), ids, room)
    assert used <= 1.05 * -(-sum(len(i) for _, i in ids) // room) + 2
    rows = packing.packed(docs, room, with_ids=True).collect()
    assert all(fx.crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in rows)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=30))
def test_configurations(counts):
    made = packing.configurations(counts, 50)
    held = Counter()
    for many, content in made:
        assert many > 0 and sum(n * c for n, c in content.items()) <= 50
        for n, c in content.items():
            held[n] += many * c
    assert held == Counter(counts)


def test_quality(spark, docs):
    got = quality.judged(docs).collect()
    want = Counter()
    for d, t, *_ in DATA:
        m = fx.measures(t)
        want[(d, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    by = {r.doc_id: r.kept for r in got}
    assert by[2001] and not any(by[d] for d, t, *_ in DATA if t and t.count("###") > 20)


def test_quality_follows_the_group(spark):
    clean = "\n".join(" ".join(f"w{i}ord{j}" for j in range(6)) for i in range(8))
    tabled = "\n".join(" | ".join(f"w{i}ord{j}" for j in range(6)) for i in range(8))  # symbols 40 of 288 characters of words
    data = [(i, clean + f" end{i}", "en", "prose", 1) for i in range(250)] + [(1000 + i, tabled + f" end{i}", "en", "tables", 1) for i in range(250)]
    data += [(5000, tabled, "en", "prose", 1), (5001, tabled, "en", "tables", 1), (5002, tabled.replace("|", "|||||"), "en", "tables", 1)]
    light = tabled.replace(" | ", " ").replace("ord1", "ord1 | |").replace("ord3", "ord3 |")  # 24 symbols
    data += [(5003, light, "en", "prose", 1), (5004, light, "en", "tables", 1)]
    data += [(6000 + i, clean, "de", "few", 1) for i in range(3)] + [(6100, tabled.replace("|", "|||||"), "de", "few", 1), (6200, "one", "fr", "none pass", 1)]
    kept = {r.doc_id: r.kept for r in quality.judged(fx.frame(spark, data)).collect()}
    assert len(kept) == len(data)
    assert {d for d, k in kept.items() if not k} == {5000, 5002, 5003, 6100, 6200}
    got = {r.decided_by: (r.groups, r.rows) for r in quality.decisions(fx.frame(spark, data)).collect()}
    assert got == {"group": (2, 505), "all": (2, 5)}
    assert [(r.decided_by, r.groups) for r in quality.decisions(fx.frame(spark, data[:100])).collect()] == [("constants", 1)]


def test_sketch_quantiles(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1, 10_001).select(F.lit("a").alias("g"), (F.col("id") / 7).alias("m"))
    parts = quality.sketch(rows.where("id % 2 = 0"), ("g",), ("m",)).union(quality.sketch(rows.where("id % 2 = 1"), ("g",), ("m",)))
    got = quality.quantiles(quality.merged(parts, ("g",)), ("g",), {"p50": 0.5, "p90": 0.9}).first()
    assert math.isclose(got.p50, 5000 / 7, rel_tol=0.011) and math.isclose(got.p90, 9000 / 7, rel_tol=0.011)


def bm25(data, queries, k):
    import re

    bags = [Counter(fx.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t, *_ in data]
    mean = sum(sum(b.values()) for b in bags) / len(bags)
    df = Counter(w for b in bags for w in b)
    out = {}
    for q, t, *_ in queries:
        ask = Counter(fx.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
        scored = []
        for (d, *_), b in zip(data, bags, strict=True):
            s = sum(
                n * math.log1p((len(data) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean))
                for w, n in ask.items() if w in b
            )
            if s > 0 and d != q:
                scored.append((-round(s, 6), d))
        out[q] = [(d, -s) for s, d in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("shard", [10_000, 20])
def test_search(spark, docs, shard, monkeypatch):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "QUERIES", 7)
    queries = [r for r in UNIQUE if r[0] % 5 == 0 or r[0] >= 1000]
    got = defaultdict(list)
    for r in search.searched(docs, fx.frame(spark, queries), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    for q, want in bm25(DATA, queries, 5).items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=3e-6)
        assert len(want) == len(got[q])


@pytest.mark.parametrize("shard", [10_000, 20])
def test_search_ids(spark, docs, shard, monkeypatch):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK", 4)
    queries = [r for r in UNIQUE if r[0] % 5 == 0 or r[0] >= 1000]
    got = defaultdict(list)
    for r in search.searched(docs, fx.frame(spark, queries), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    assert {q: got[q] for q in got} == {q: [d for d, _ in want] for q, want in bm25(DATA, queries, 5).items() if want}


def test_rounded_ties_in_another_block(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 1)
    term = np.array([1], np.uint64)
    index = search.Index([(term, np.array([1]))] * 12, np.ones(12), term, 1.0)
    index.impact[:] = index.own_impact[:] = index.most[:] = [1.0] * 6 + [1.0 - 3e-7] * 6  # all are 1 when rounded
    best, score = index.top(np.array([0]), np.array([1.0]), 2, np.array([], int))
    assert best.tolist() == list(range(12)) and set(score) == {1.0}


def test_licenses(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code"), ("a/b/y.py", "Licensed under CC BY-NC 4.0.\ncode"),
        ("c/COPYING", "hello"), ("c/z", None), ("a/b/c/LICENSE.txt", "x\nLicensed under the Apache License, Version 2.0."), ("a/b/c/d/e/f", ""),
        ("root", "the license of the version"), (None, "Released under the MIT License."), (None, None), ("a/b/x.py", "code"), ("short", "CC BY-NC 4.0"),
    ]
    df = spark.createDataFrame([(p, t, 1, "x") for p, t in files], "path string, text string, n int, line string")
    got = Counter((r.path, r.own_license, r.license, r.inherited_from) for r in licenses.scanned(df).collect())
    assert got == Counter(
        [
            ("a/LICENSE", "MIT", "MIT", None), ("a/b/x.py", None, "MIT", "a"), ("a/b/x.py", None, "MIT", "a"), ("a/b/y.py", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
            ("c/COPYING", None, None, None), ("c/z", None, None, None), ("a/b/c/LICENSE.txt", "Apache-2.0", "Apache-2.0", None),
            ("a/b/c/d/e/f", None, "Apache-2.0", "a/b/c"), ("root", None, None, None), (None, "MIT", "MIT", None), (None, None, None, None),
            ("short", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        ]
    )
    assert licenses.scanned(df.limit(0)).count() == 0


def test_licenses_over_lines_and_inside(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
        "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies"
    )
    gpl = (
        "# This program is free software: you can\n# redistribute it and/or modify it under the\n# terms of the GNU General Public License as\n"
        "# published by the Free Software Foundation,\n# either version 3 of the License\nimport os"
    )
    isc = "REM Permission to use, copy, modify,\nREM and/or distribute this software for\nREM any purpose with or without fee is\nREM hereby granted"
    filler = "the house of the man and this is in the work of all to be or not by any " * 20
    files = [
        ("mit", mit, "MIT"), ("gpl", gpl, "GPL-3.0"), ("isc", isc, "ISC"), ("inline", f"{filler}Released under the MIT License. {filler}", "MIT"),
        ("bsd", "// Redistribution and use in source and binary forms, with or without modification,\n// are permitted provided that the following conditions are met:", "BSD-3-Clause"),
        ("c", "/*\n * Licensed under\n * CC BY 4.0.\n */", "CC-BY-4.0"), ("plain", filler, None), ("few", f"license {filler} software {filler} version", None),
        ("apart", f"Permission is hereby {filler} granted free of {filler} charge to any person {filler} obtaining a copy", None), ("none", None, None),
    ]
    files += [(f"other{i}", f"{filler}{i}", None) for i in range(60)]
    df = spark.createDataFrame([(p, t) for p, t, _ in files], "path string, text string").repartition(3)
    got = {r.path: r.own_license for r in licenses.scanned(df).collect()}
    assert got == {p: k for p, _, k in files}


def test_sister_licenses(spark):
    texts = {
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public\nLicense as published by the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General\nPublic License as published by the Free Software Foundation; either version 2.1 of the License.",
        "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General\nPublic License, version 3, as published by the Free Software Foundation",
        "CC-BY-4.0": "Licensed under CC BY 4.0.",
        "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
        "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
        "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    }
    plain = [(f"p/{i}.txt", f"a line about nothing in particular, number {i}") for i in range(60)]
    got = licenses.scanned(spark.createDataFrame([(f"f/{n}.c", t) for n, t in texts.items()] + plain, "path string, text string")).collect()
    assert {r.path: r.own_license for r in got if r.path.startswith("f/")} == {f"f/{n}.c": n for n in texts}
    assert all(r.license is None for r in got if r.path.startswith("p/"))


def test_urls(spark):
    cases = [
        ("http://a.example.net/en/1", "allow", "example.net/en/"), ("https://EXAMPLE.net/de/1?x", "block", "net/"), ("x://example.net", "allow", None),
        ("http://example.com/de/", "block", "example.com/de/"), ("http://example.com/de", "allow", None), ("http://notexample.com/de/", "allow", None),
        ("http://b.org/fr/a#b", "allow", "org/fr/"), ("http://org/fr/", "allow", "org/fr/"), ("http://spam-farm.example.org/en/2", "block", None),
        ("http://spam-farm.example.org/fr/2", "allow", "org/fr/"), (None, "allow", None), ("no scheme", "allow", None), ("", "allow", None),
        ("http://a.com/x/login", "block", None), ("http://a.com/xlogin", "allow", None), ("http://x.com/?u=://y.net/", "allow", None),
        ("http://x.com/a\nb/cart/", "block", None), ("http://example.net:80/en/", "allow", None),
    ]
    df = spark.createDataFrame([(i, c[0], "h", "p") for i, c in enumerate(cases)] + [(0, cases[0][0], "h", "p")], "page_id long, url string, host string, tokens string")
    got = urls.filtered(df).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r.verdict, r.rule) == cases[r.page_id][1:], cases[r.page_id]
    loose = [*urls.PLACES, urls.Rule("z{3}", "block", ())]
    df = spark.createDataFrame([(1, "http://a.com/zzz"), (2, "http://a.com/zz")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.filtered(df, loose).collect()} == {1: "block", 2: "allow"}
    assert urls.filtered(df.limit(0)).count() == 0


def test_toxicity(spark):
    import random
    import zlib

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    data, labels = [], []
    for i in range(400):
        w = rng.choices(words, k=80)
        if i % 5 == 0:
            w[rng.randrange(80)] = rng.choice(["vilewords", "nastyterm"])
            w[rng.randrange(80)] = "horrible"
        data.append((i, " ".join(w), "en", "a", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    data += [(1000, None, None, None, None), (None, "horrible", None, None, None), (1001, "", "en", "a", 0), (3, data[3][1], "en", "a", 1)]
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(fx.frame(spark, data), label).collect()
    assert len(got) == len(data)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.score == 0 for r in toxicity.toxicity(fx.frame(spark, data), label.limit(0)).collect())


def test_toxic_words_of_few_bytes_and_word_starts():
    import random

    rng = random.Random(7)
    syllables = ["bra", "ko", "lin", "tu", "ves", "ma", "dro", "pel", "si", "gan", "rof", "ute"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    ordinary = [" ".join(word() for _ in range(120)) for _ in range(600)]
    toxic = [" ".join([*(word() for _ in range(60)), rng.choice(["scum", "dolt", "kolin" + word()]), word(), "dolt"]) for _ in range(150)]
    model = toxicity.trained(toxic[:100], ordinary[:400])
    both = model.compressors()
    score = lambda texts: model.score(toxicity.features([model.gains(both, t) for t in texts]))
    assert (score(toxic[100:]) >= 0.5).mean() >= 0.9
    assert (score(ordinary[400:]) >= 0.5).mean() <= 0.05


def test_sampled_stretches_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_CHARS", 64)
    rows = spark.createDataFrame([("".join(f"{i:04d}" for i in range(100)),), ("short",), ("",)], "text string")
    long, short, empty = (r.t for r in rows.select(toxicity._spread(toxicity.F.col("text")).alias("t")).collect())
    assert (short, empty) == ("short", "") and long.startswith("0000") and long.endswith("0099")
    assert len(long.split()) == toxicity.STRETCHES and len(long) == 64 + toxicity.STRETCHES - 1


def test_toxicity_learns_from_all_sampled_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda size, samples: seen.extend(samples) or toxicity.zstandard.ZstdCompressionDict(b"x" * 64))
    monkeypatch.setattr(toxicity, "TRAINING_BYTES", 20_000)
    toxicity._dictionary(64, [[b" early text %06d " % i for i in range(300_000)], *[[b" late text %d " % i] for i in range(50)]])
    assert sum(b"late" in s for s in seen) == 50 and sum(map(len, seen)) <= 20_000 and any(b"early text 29" in s for s in seen)
    got = []
    monkeypatch.setattr(toxicity, "trained", lambda toxic, ordinary: got.append((toxic, ordinary)))
    rows = [(1, f"shared {i}", "en", "a", 1) for i in range(40)] + [(2, "bad", "en", "a", 1)]
    toxicity.fitted(fx.frame(spark, rows), spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int"), "true")
    assert got == [(["bad"], ["shared 0"])]


def test_no_rows(spark, none):
    label = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = [
        mixing.mixed(none), suffix.without_repeats(none), near.near_duplicates(none), tokens.token_counts(none), packing.packed(none),
        quality.judged(none), search.searched(none, none), toxicity.toxicity(none, label),
    ]
    assert [df.count() for df in frames] == [0] * len(frames)


def test_search_batches(spark, monkeypatch):
    """A shard reaches its worker in batches of few bytes, and the setting is as before afterwards."""
    monkeypatch.setattr(runtime, "BATCH_BYTES", 20_000)
    plain = search._answered

    def checked(k, mean):
        def rows(left, right):
            assert left.num_rows < 200 or max(map(len, left["terms"].chunks)) < left.num_rows / 2, "all in one batch"
            return plain(k, mean)(left, right)

        return rows

    monkeypatch.setattr(search, "_answered", checked)
    texts = [(i, f"common word{i} " + " ".join(f"w{j}" for j in range(i % 40))) for i in range(400)] + [(500, ""), (501, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    before = spark.conf.get(runtime.BATCH_LIMIT, None)
    got = search.searched(docs, docs.where("doc_id < 3 OR doc_id >= 500"), k=5)
    assert spark.conf.get(runtime.BATCH_LIMIT, None) == before
    assert {q: n for q, n in got.groupBy("query_id").count().collect()} == {0: 5, 1: 5, 2: 5}


def test_search_waves():
    assert search.waves(1, 1) == [(0, 1)]
    assert search.waves(6, 1) == [(0, 1), (1, 2), (2, 4), (4, 6)]
    got = search.waves(1_500, 37)  # many blocks of queries: short waves
    assert max(b - a for a, b in got) == 41 and [a for a, _ in got][1:] == [b for _, b in got][:-1] and got[-1][1] == 1_500


@pytest.mark.parametrize("lookups", [1 << 20, 40])
def test_least_score_loses_nothing(monkeypatch, lookups):
    monkeypatch.setattr(search, "BLOCK", 8)
    monkeypatch.setattr(search, "PART", 50)
    monkeypatch.setattr(search, "LOOKUPS", lookups)
    rng = np.random.default_rng(3)
    bags = [np.unique(np.minimum(rng.zipf(1.3, 30), 400).astype(np.uint64), return_counts=True) for _ in range(300)]
    words = np.array([c.sum() for _, c in bags], float)
    asked = np.arange(1, 401, dtype=np.uint64)
    index = search.Index(bags, words, asked, words.mean())
    terms, weights = rng.choice(400, 25, replace=False), rng.random(25) * 9
    norm = search.K1 * (1 - search.B + search.B * words / words.mean())
    dense = np.zeros((300, 400))
    for d, (t, c) in enumerate(bags):
        dense[d, t.astype(int) - 1] = c * (search.K1 + 1) / (c + norm[d])
    plain = np.round(dense[:, terms] @ weights, 6)
    plain[7] = 0
    want = np.sort(plain)[::-1][:10]
    for least in (0.0, want[9] * 0.5, want[9]):
        _, got = index.top(terms, weights, 10, np.array([7]), least)
        assert np.sort(got)[::-1][:10] == pytest.approx(want, abs=2e-6)
    assert len(index.top(terms, weights, 10, np.array([7]), want[0] * 50)[0]) == 0


@pytest.mark.parametrize("sizes", [{}, {"LOOKUPS": 30, "TOGETHER": 3}, {"DENSE": 0.0, "COLUMNS": 5}, {"DENSE": 9.0}])
def test_queries_scored_together(monkeypatch, sizes):
    """Queries of a block share one pass over a shard; copies, ties and a query's own rows are as in plain BM25."""
    for name, value in ({"BLOCK": 16} | sizes).items():
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(5)
    data = [(i, " ".join(f"w{w}" for w in np.minimum(rng.zipf(1.4, 12), 60))) for i in range(90)]
    data += [(i, "same words here w1") for i in range(90, 130)] + [(95, "same words here w1"), (400, ""), (401, None)]
    queries = [r for r in data[:130] if r[0] % 3 == 0]
    frequency = Counter(w for _, t in data for w in set((t or "").split()))
    bags = [search.bag(t) for _, t in data]
    words = [int(c.sum()) for _, c in bags]
    code = {w: int(search.bag(w)[0][0]) for w in frequency}
    docs = pa.table({
        "doc_id": [d for d, _ in data], "words": words,
        "terms": [t.tobytes() for t, _ in bags], "counts": [c.astype("<u4").tobytes() for _, c in bags],
    })
    packed = []
    for q, t in queries:
        w = {code[w]: n * math.log1p((len(data) - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w, n in Counter(t.split()).items()}
        packed.append((q, np.array(sorted(w), np.uint64).tobytes(), np.array([w[c] for c in sorted(w)], float).tobytes(), 0.0))
    right = pa.table(dict(zip(("query_id", "terms", "weights", "least"), map(list, zip(*packed)), strict=True)))

    def alone(*_):
        raise AssertionError("one query at a time")

    monkeypatch.setattr(search.Index, "top", alone)
    got = defaultdict(list)
    for r in search._answered(5, sum(words) / len(words))(docs, right).to_pylist():
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    want = bm25(data, queries, 5)
    assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items()}
    for q, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[q]], abs=2e-6)


def test_search_moves_texts_once(spark, monkeypatch):
    """Texts are not repeated for blocks of queries, queries not for shards."""
    monkeypatch.setattr(search, "SHARD", 30)
    monkeypatch.setattr(search, "QUERIES", 4)
    plans, plain = [], search.durable

    def noted(df):
        told = io.StringIO()
        with contextlib.redirect_stdout(told):
            df.explain()
        plans.append(told.getvalue())
        return plain(df)

    monkeypatch.setattr(search, "durable", noted)
    docs = spark.createDataFrame([(i, f"common word{i % 7} other{i % 11}") for i in range(120)], "doc_id long, text string")
    got = search.searched(docs, docs.where("doc_id % 10 = 0"), k=3)
    assert {q: n for q, n in got.groupBy("query_id").count().collect()} == dict.fromkeys(range(0, 120, 10), 3)
    assert not [p for p in plans if "explode" in p or "CoGroup" in p]
