"""Fuzzy title match without scoring every title with every handle.

Two texts can only be similar if they share enough characters: with m matches and t transpositions, Jaro is
``(m/|a| + m/|b| + (m - t)/m) / 3``, and m is at most the number of characters (repeats numbered) the two share.
Where two characters that each text has once stand in another order, one of them is not matched or t is at least 1.
The Winkler boost needs a common prefix, so its length decides which Jaro value a pair needs.

Texts are dealt evenly into blocks, and each block of one side meets each block of the other in a cell: a text is copied
once for each block of the other side, whatever characters it has. Within a cell, texts with the same prefix, the same
characters and the same order of single ones form one group. The bounds are evaluated on pairs of groups, as bit sets, and
the similarity itself on the texts of those pairs of groups that are left. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ascii_only, squish
from ..functions.similarity import BOOST_ABOVE, PREFIX_MAX, PREFIX_SCALE, jaro_winkler_col, similarities
from ..runtime import durable

NO_NAME = "Not Defined"  # fixed value: name of a handle without one

#: The most frequent characters of a cell get a bit each; all others have lists of the groups that hold them.
WORD_BITS = 62
WORDS = 4
#: Texts, and characters, in a block of the smaller side; the other side has blocks of WIDER times as many.
ROWS_PER_SPLIT = 16_384
CHARS_PER_SPLIT = 1 << 19
WIDER = 4
#: Characters whose order is compared, if at least this part of either side's texts has them once.
ORDERED = 11
SINGLE_IN = 0.5
#: Pairs of groups bounded at once, and characters of pairs of texts scored at once.
BOUNDS = 1 << 18
SCORED_CHARS = 1 << 20
_EPS = 1e-6  # similarities are rounded to six places


def least_jaro(threshold: float, prefix: int) -> float:
    """The Jaro value a pair needs to exceed ``threshold`` with a common prefix of this length."""
    boost = PREFIX_SCALE * prefix
    needed = (threshold - boost) / (1.0 - boost)
    return min(threshold, max(needed, BOOST_ABOVE))


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers of several ranges in a row."""
    return np.arange(int(many.sum())) + np.repeat(start - np.cumsum(many) + many, many)


class Groups:
    """Texts of one side of a cell, in groups that the bounds cannot tell apart."""

    def __init__(self, keys: np.ndarray, texts: np.ndarray, heads: np.ndarray, lens: np.ndarray, words: np.ndarray, rare: list[tuple], order: np.ndarray, once: np.ndarray):
        rares = pd.factorize(np.array([*rare, None], dtype=object)[:-1])[0]
        columns = np.column_stack([heads, lens, words, rares, order, once])
        by = np.lexsort(columns[:, ::-1].T)  # first by head and length
        columns = columns[by]
        first = np.flatnonzero(np.r_[True, (columns[1:] != columns[:-1]).any(axis=1)])
        self.keys, self.texts, self.text_lens = keys[by], texts[by], lens[by]
        self.start, self.many = first, np.diff(np.r_[first, len(by)])
        one = by[first]
        self.heads, self.lens, self.words = heads[one], lens[one], np.ascontiguousarray(words[one].T)
        self.rare, self.order, self.once = [rare[i] for i in one], order[one], once[one]


def _tokens(lens: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each character of some texts, its text, and as a token: the character with the number of its occurrence."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lens)
    order = np.lexsort((chars, owner))  # the texts stay in their places
    sorted_chars = chars[order]
    fresh = np.flatnonzero(np.r_[True, (sorted_chars[1:] != sorted_chars[:-1]) | (owner[1:] != owner[:-1])])
    nth = np.arange(len(chars)) - np.repeat(fresh, np.diff(np.r_[fresh, len(chars)]))
    return chars, owner, sorted_chars << 32 | nth


def _bits(n: int, owner: np.ndarray, tokens: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """The frequent tokens of each text as bits, and its other ones."""
    at = np.full(len(tokens), -1)
    by = np.argsort(top)
    near = np.minimum(np.searchsorted(top, tokens, sorter=by), len(top) - 1)
    found = top[by[near]] == tokens
    at[found] = by[near[found]]
    words = np.zeros((n, -(-len(top) // WORD_BITS)), np.int64)
    held = at >= 0
    np.bitwise_or.at(words, (owner[held], at[held] // WORD_BITS), np.int64(1) << (at[held] % WORD_BITS))
    rare: list[list[int]] = [[] for _ in range(n)]
    for i, t in zip(owner[~held].tolist(), tokens[~held].tolist()):
        rare[i].append(t)
    return words, [tuple(r) for r in rare]


def _once(n: int, chars: np.ndarray, owner: np.ndarray, char: int) -> np.ndarray:
    """Where a character stands in each text, counted over all texts; -1 if it is not there exactly once."""
    at = np.flatnonzero(chars == char)
    place = np.full(n, -1)
    place[owner[at]] = at
    place[np.bincount(owner[at], minlength=n) != 1] = -1
    return place


def _orders(places: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A bit for each two of the characters: whether the first stands before the second, and whether a text has both once."""
    order, once = np.zeros(n, np.int64), np.zeros(n, np.int64)
    pairs = [(x, y) for i, x in enumerate(places) for y in places[:i]]
    for bit, (x, y) in enumerate(pairs):
        both = (x >= 0) & (y >= 0)
        once |= both.astype(np.int64) << bit
        order |= (both & (x < y)).astype(np.int64) << bit
    return order, once


def _grouped(sides: list[pd.DataFrame]) -> list[Groups]:
    texts = [f["text"].to_numpy(dtype=object) for f in sides]
    lens = [np.fromiter(map(len, t), np.int64, len(t)) for t in texts]
    parts = [_tokens(n, t) for n, t in zip(lens, texts)]
    token, count = np.unique(np.concatenate([np.unique(p[2]) for p in parts]), return_counts=True)
    token = token[count == 2]  # a token of one side alone is never shared
    often = sum(np.bincount(np.searchsorted(token, p[2][np.isin(p[2], token)]), minlength=len(token)) for p in parts)
    top = token[np.argsort(-often, kind="stable")][: WORDS * WORD_BITS]
    shared = [np.isin(p[2], token) for p in parts]
    words = [_bits(len(t), p[1][s], p[2][s], top) if len(top) else (np.zeros((len(t), 0), np.int64), [()] * len(t)) for t, p, s in zip(texts, parts, shared)]
    single = []
    for c in np.unique(top >> 32).tolist():
        places = [_once(len(t), p[0], p[1], c) for t, p in zip(texts, parts)]
        share = min(float((x >= 0).mean()) for x in places)
        if share >= SINGLE_IN:
            single.append((-share, c, places))
    single = sorted(single, key=lambda x: x[:2])[:ORDERED]
    orders = [_orders([s[2][i] for s in single], len(t)) for i, t in enumerate(texts)]
    heads = []  # numbers of the prefixes of each length, -1 for a shorter text
    for k in range(1, PREFIX_MAX + 1):
        number = pd.factorize(np.concatenate([np.array([*[x[:k] for x in t], None], dtype=object)[:-1] for t in texts]))[0]
        heads.append(np.where(np.concatenate(lens) >= k, number, -1))
    split = np.split(np.column_stack(heads), [len(texts[0])])
    return [
        Groups(f["key"].to_numpy(), t, h, n, w, r, *o)
        for f, t, h, n, (w, r), o in zip(sides, texts, split, lens, words, orders)
    ]


def _likely(a: Groups, b: Groups, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of groups that the bounds leave, some at a time."""
    least = 3.0 * (np.array([least_jaro(threshold, i) for i in range(PREFIX_MAX + 1)]) - _EPS)
    holders: dict[int, list[int]] = {}
    for j, tokens in enumerate(b.rare):
        for t in tokens:
            holders.setdefault(t, []).append(j)
    step = max(1, BOUNDS // len(b.lens))
    alike = np.flatnonzero(np.r_[True, (a.heads[1:, 0] != a.heads[:-1, 0]) | (a.lens[1:] != a.lens[:-1])])
    for start, stop in zip(alike, [*alike[1:], len(a.lens)]):
        la = a.lens[start]
        needed = np.where(b.heads[:, 0] == a.heads[start, 0], least[-1], least[0]) - 1.0
        needed = np.ceil(needed * la * b.lens / (la + b.lens)).astype(np.int32)
        feasible = needed <= np.minimum(la, b.lens)
        if not feasible.any():
            continue
        for i in range(start, stop, step):
            g = slice(i, min(stop, i + step))
            m = np.zeros((g.stop - i, len(b.lens)), np.int32)
            for x, y in zip(a.words, b.words):
                m += np.bitwise_count(x[g, None] & y[None, :])
            for row, tokens in enumerate(a.rare[g]):
                for t in tokens:
                    m[row, holders.get(t, [])] += 1
            x, y = np.nonzero(m >= np.maximum(needed, 1)[None, :])
            m, x = m[x, y].astype(float), x + i
            lb = b.lens[y].astype(float)
            share = 1.0 / la + 1.0 / lb
            crossed = ((a.order[x] ^ b.order[y]) & a.once[x] & b.once[y]) != 0
            most = np.where(crossed, np.maximum((m - 1) * share + 1.0, m * share + 1.0 - 1.0 / m), m * share + 1.0)
            prefix = ((a.heads[x] == b.heads[y]) & (a.heads[x] >= 0)).sum(axis=1)
            left = most >= least[prefix]
            yield x[left], y[left]


def _cell(sides: list[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    a, b = _grouped(sides)
    for x, y in _likely(a, b, threshold):
        each = a.many[x] * b.many[y]
        cost = np.cumsum(each * (a.lens[x] + b.lens[y])) // SCORED_CHARS
        for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(cost)) + 1):
            for i, j in _pairs_of(a, b, x[part], y[part]):
                similarity = similarities(a.texts[i], b.texts[j])
                kept = similarity > threshold
                if kept.any():
                    yield pd.DataFrame({"a_key": a.keys[i[kept]], "b_key": b.keys[j[kept]], "similarity": similarity[kept]})


def _pairs_of(a: Groups, b: Groups, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of texts of some pairs of groups, a bounded number at a time."""
    i = _ranges(a.start[x], a.many[x])
    y = np.repeat(y, a.many[x])  # each text of the one side with a group of the other
    many = b.many[y]
    cost = np.cumsum(many * (a.text_lens[i] + b.lens[y])) // SCORED_CHARS
    for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(cost)) + 1):
        yield np.repeat(i[part], many[part]), _ranges(b.start[y[part]], many[part])


def _matched(threshold: float):
    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell = pd.concat(list(frames), ignore_index=True)
        sides = [cell[cell["side"] == s] for s in (1, 2)]
        del cell
        if all(len(s) for s in sides):
            yield from _cell(sides, threshold)

    return pairs


def similar_texts(left: DataFrame, right: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All pairs of distinct texts with a similarity above ``threshold``: ``a, b, similarity``.

    Both inputs have one column ``text``. Every pair is compared in one place only: the cell of their two blocks.
    """
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must lie between 0 and 1")
    sides = left.select("text", F.lit(1).alias("s")).unionByName(right.select("text", F.lit(2).alias("s")))
    texts = durable(
        sides.where(F.length("text") > 0)
        .groupBy("text")
        .agg(F.bit_or("s").alias("sides"))
        .select("text", "sides", F.monotonically_increasing_id().alias("key"))
    )
    on = [texts.where(F.col("sides").bitwiseAND(s) != 0).select("key", "text") for s in (1, 2)]
    held = [side.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first() for side in on]
    wider = [WIDER if mine[0] > other[0] else 1 for mine, other in (held, held[::-1])]
    blocks = [1 + max(n // (ROWS_PER_SPLIT * w), chars // (CHARS_PER_SPLIT * w)) for (n, chars), w in zip(held, wider)]
    block = [F.pmod(F.xxhash64("key"), F.lit(n)) for n in blocks]
    others = [F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")) for n in blocks]
    cells = on[0].select("key", "text", F.lit(1).alias("side"), block[0].alias("x"), others[1].alias("y")).unionByName(
        on[1].select("key", "text", F.lit(2).alias("side"), others[0].alias("x"), block[1].alias("y"))
    )
    found = cells.groupBy("x", "y").applyInPandas(_matched(threshold), "a_key long, b_key long, similarity double")
    # the estimate of a user function's rows is a guess, so it must not turn these into broadcasts
    a, b = (side.select(F.col("key").alias(f"{n}_key"), F.col("text").alias(n)).hint("merge") for n, side in zip("ab", on))
    return found.join(a, "a_key").join(b, "b_key").select("a", "b", "similarity")


def distinct_titles(titles: DataFrame) -> DataFrame:
    """Distinct ``title, category``; quotes in titles are removed."""
    return titles.select(F.replace("title", F.lit('"'), F.lit("")).alias("title"), "category").distinct()


def fuzzy_match(titles: DataFrame, handles: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Titles against handles: ``title, category, handle, name, handle_category, handle_sim, title_sim, squish``.

    ``titles`` has ``title, category``; ``handles`` has ``handle, name, category``. A pair is kept if the lower-case
    title stripped to word characters equals the handle (``squish``), or if its similarity to the name or to
    the handle exceeds the threshold.
    """
    t = distinct_titles(titles).withColumn("lt", F.lower("title"))
    name = ascii_only(F.coalesce("name", F.lit(NO_NAME)))
    h = handles.select("handle", name.alias("name"), F.col("category").alias("handle_category")).distinct()
    owners = h.select("handle", "name", F.lower("handle").alias("lh"), F.lower("name").alias("ln")).distinct()

    pairs = similar_texts(
        t.select(F.col("lt").alias("text")),
        owners.select(F.explode(F.array("lh", "ln")).alias("text")),
        threshold,
    ).select(F.col("a").alias("lt"), "b")
    by_either = pairs.join(
        owners.select("handle", "name", F.explode(F.array_distinct(F.array("lh", "ln"))).alias("b")), "b"
    )
    by_squish = t.select("lt", squish("lt").alias("handle")).distinct().join(owners.select("handle", "name"), "handle")
    kept = by_either.select("lt", "handle", "name").unionByName(by_squish.select("lt", "handle", "name")).distinct()
    scored = kept.select(
        "lt",
        "handle",
        "name",
        jaro_winkler_col("lt", F.lower("handle")).alias("handle_sim"),
        jaro_winkler_col("lt", F.lower("name")).alias("title_sim"),
        (squish("lt") == F.col("handle")).alias("squish"),
    )
    return (
        scored.join(t, "lt")
        .join(h, ["handle", "name"])
        .select("title", "category", "handle", "name", "handle_category", "handle_sim", "title_sim", "squish")
    )


def squish_match(titles: DataFrame, handles: DataFrame) -> DataFrame:
    """Only the pairs whose stripped lower-case title equals the handle: ``title, category, handle``."""
    t = distinct_titles(titles).withColumn("handle", squish(F.lower("title")))
    return t.join(handles.select("handle").distinct(), "handle", "left_semi").select("title", "category", "handle")
