"""License scan: TF-IDF cosine of lines and of runs of words to license templates, then inheritance from the nearest licensed directory."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import compute_once, durable, small_side
from .common import carried, text_key

#: Short notices and header lines of public licenses (fixed values).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3, as published by the Free Software Foundation"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3, as published by the Free Software Foundation"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)
NEAR = 0.75
#: Words that only mark a line as a comment, left out where a notice may run over several lines.
MARKS = r"(?mi)^[^a-z0-9\n]*(?:rem|dnl)\b"
LICENSE_FILE = r"(?i)\A(licen[cs]e|copying|notice)([._-].*)?\z"


def tokens_of(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda t: t != "")


def _template_tokens(text: str) -> list[str]:
    return [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split() if t]


def found_licenses(files: DataFrame, near: float = NEAR) -> tuple[DataFrame, list[str], dict[str, float]]:
    """``line, license, score`` for each distinct line of ``files(text)`` whose cosine to a template is ``near`` or more,
    the rarer words of the templates, and the weight of each of their words.

    Document frequencies of the templates' words are counted over all files. Lines that hold none of the rarer words cannot
    reach ``near``: what the other words contribute to a template's length is below it, which the choice of
    the rarer words ensures; so only the lines that hold one are compared.
    """
    spark = files.sparkSession
    vocabulary = sorted({t for _, text in TEMPLATES for t in _template_tokens(text)})
    known = F.array(*[F.lit(t) for t in vocabulary])
    held = files.select(F.explode(F.array_intersect(tokens_of(F.coalesce("text", F.lit(""))), known)).alias("term"))
    counted = {r.term: r.files for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("files")).collect()}  # the templates' words only
    total = files.count()
    weight = {t: math.log((1 + total) / (1 + counted.get(t, 0))) + 1e-9 for t in vocabulary}
    vectors = []
    for i, (name, text) in enumerate(TEMPLATES):
        many = Counter(_template_tokens(text))
        length = math.sqrt(sum((n * weight[t]) ** 2 for t, n in many.items()))
        vectors += [(i, name, t, n * weight[t] / length) for t, n in many.items()]
    common: set[str] = set()
    for term in sorted(vocabulary, key=lambda t: weight[t]):  # as many of the commonest as stay below the bound
        tried = common | {term}
        if all(sum(w * w for i, _, t, w in vectors if i == k and t in tried) < (0.98 * near) ** 2 for k in range(len(TEMPLATES))):
            common = tried
    rarer = [t for t in vocabulary if t not in common]
    rare = F.array(*[F.lit(t) for t in rarer])
    lines = files.select(F.explode(F.split("text", "\n")).alias("line")).where(F.arrays_overlap(tokens_of(F.col("line")), rare)).distinct()
    template = F.broadcast(spark.createDataFrame(vectors, "template int, license string, term string, part double"))
    idf = F.broadcast(spark.createDataFrame(list(weight.items()), "term string, idf double"))
    terms = lines.select("line", F.explode(tokens_of(F.col("line"))).alias("term")).join(idf, "term")
    terms = terms.groupBy("line", "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("w"))
    length = terms.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = terms.join(template, "term").groupBy("line", "template", "license").agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    scored = dot.join(length, "line").select("line", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score")).where(F.col("score") >= near)
    best = scored.groupBy("line").agg(F.max(F.struct("score", "license")).alias("b"))
    return best.select("line", "b.license", "b.score"), rarer, weight


def runs_of_words(rows: DataFrame, rarer: list[str], weight: dict[str, float], near: float = NEAR) -> DataFrame:
    """``_key`` and the best ``own(score, license)`` of the runs of words in ``rows(_key, text)`` that are ``near`` a template.

    A run begins at a word of the template and has as many words as the template, or a quarter more; line ends and comment
    marks do not count. So wrapped, commented and inline notices are found. The cosine is that of lines. What is skipped
    cannot reach ``near``: by Cauchy-Schwarz a cosine is at most the length of the template's part that the text holds.
    """
    words = F.array(*[F.lit(t) for t in weight])
    idf = F.create_map(*[x for t, w in weight.items() for x in (F.lit(t), F.lit(w))])
    kinds = []
    for name, text in TEMPLATES:
        many = Counter(_template_tokens(text))
        n, length = sum(many.values()), math.sqrt(sum((k * weight[t]) ** 2 for t, k in many.items()))
        part = F.create_map(*[x for t, k in many.items() for x in (F.lit(t), F.lit(k * weight[t] / length))])
        kinds.append(F.struct(F.lit(name).alias("license"), F.array(F.lit(n), F.lit(n + -(-n // 4))).alias("sizes"), F.array(*[F.lit(t) for t in many]).alias("terms"), part.alias("part")))
    enough = lambda held, k: F.aggregate(
        F.array_intersect(held, k["terms"]), F.lit(0.0), lambda a, t: a + F.element_at(k["part"], t) * F.element_at(k["part"], t)
    ) >= F.lit((near - 1e-6) ** 2)
    tokens = tokens_of(F.regexp_replace("text", MARKS, " "))
    seen = compute_once(rows.where("text IS NOT NULL"), "_key", tokens.alias("tokens"))
    seen = compute_once(seen.where(F.arrays_overlap("tokens", F.array(*[F.lit(t) for t in rarer]))), "_key", "tokens", F.array_intersect("tokens", words).alias("held"))
    few = seen.select("_key", "tokens", F.explode(F.filter(F.array(*kinds), lambda k: enough(F.col("held"), k))).alias("k"))
    token, size = F.col("tokens"), F.size("tokens")
    starts = F.filter(F.sequence(F.lit(1), size), lambda i: F.array_contains(F.col("k.terms"), F.element_at(token, i)))
    run = lambda i, n: F.transform(F.sequence(i, F.least(size, i + n - 1)), lambda j: F.element_at(token, j))
    at = F.flatten(F.transform(F.col("k.sizes"), lambda n: F.filter(F.transform(starts, lambda i: run(i, n)), lambda r: enough(r, F.col("k")))))
    runs = few.select("_key", "k", F.explode(at).alias("run"))
    times = lambda t: F.size(F.filter("run", lambda x: x == t)) * F.element_at(idf, t)
    held = compute_once(runs, "_key", "k", F.transform(F.array_intersect("run", words), lambda t: F.struct(t.alias("t"), times(t).alias("w"))).alias("held"))
    dot = F.aggregate("held", F.lit(0.0), lambda a, x: a + x["w"] * F.coalesce(F.try_element_at(F.col("k.part"), x["t"]), F.lit(0.0)))
    length = F.sqrt(F.aggregate("held", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
    scored = held.select("_key", F.round(dot / length, 6).alias("score"), F.col("k.license").alias("license")).where(F.col("score") >= near)
    return scored.groupBy("_key").agg(F.max(F.struct("score", "license")).alias("own"))


def scanned(files: DataFrame, near: float = NEAR) -> DataFrame:
    """``files(path, text, ...)`` without its text and with ``own_license, score, license, inherited_from``.

    A file's own license is that of its best line or run of words. Files named like a license file stand for their directory; a file
    without an own license takes that of the nearest directory above it that has one. Equal scores go to the later name, of
    equal directories the better score counts. A null or empty text has no own license, a null path inherits
    nothing; repeated rows stay and are judged alike. DataFrame functions only.
    """
    files, own_columns = carried(files, ["path", "text"], ["text", "own_license", "score", "license", "inherited_from"])
    rows = files.withColumn("_key", F.xxhash64(F.coalesce("path", F.lit("")), text_key()))
    found, rarer, weight = found_licenses(files.select("text"), near)
    best = durable(found)
    lines = rows.where("text IS NOT NULL").select("_key", F.explode(F.split("text", "\n")).alias("line"))
    one_of = rf"(?<![a-z0-9])({'|'.join(rarer)})(?![a-z0-9])"  # every line of ``best`` holds one
    hits = lines.where(F.lower("line").rlike(one_of))
    own = hits.join(small_side(best), "line").select("_key", F.struct("score", "license").alias("own"))
    own = own.unionByName(runs_of_words(rows.select("_key", "text"), rarer, weight, near)).groupBy("_key").agg(F.max("own").alias("own"))
    known = durable(rows.select("path", "_row", "_key").join(own, "_key", "left"))

    folder = F.regexp_replace("path", r"/?[^/]*\z", "")
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    marked = known.where(name.rlike(LICENSE_FILE) & F.col("own").isNotNull()).groupBy(folder.alias("up")).agg(F.max("own").alias("of_up"))
    folders = known.where("own IS NULL AND path IS NOT NULL").select(folder.alias("folder")).distinct()
    steps = F.transform(
        F.sequence(F.lit(0), F.size(F.split("folder", "/"))), lambda i: F.array_join(F.slice(F.split("folder", "/"), F.lit(1), i), "/")
    )
    above = folders.select("folder", F.explode(F.array_distinct(steps)).alias("up")).join(marked, "up")
    nearest = above.groupBy("folder").agg(F.max(F.struct(F.length("up").alias("n"), F.col("up"), F.col("of_up"))).alias("near"))
    joined = known.withColumn("_folder", F.when(F.col("own").isNull(), folder)).join(nearest, F.col("_folder") == F.col("folder"), "left")
    return joined.select(
        *own_columns,
        F.col("own.license").alias("own_license"),
        F.coalesce("own.score", "near.of_up.score").alias("score"),
        F.coalesce("own.license", "near.of_up.license").alias("license"),
        F.col("near.up").alias("inherited_from"),
    )
