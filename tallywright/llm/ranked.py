"""Ranked lexical search: best-first document intervals, bounded by range maxima of each term's posting list.

Documents are dealt to shards. A shard's postings lie in one array, by term and then by document, under a sparse table
of range maxima. An interval of documents can score no more than the sum of its terms' range maxima; the interval of
greatest bound is split at the document of its greatest single impact, which is scored, until no bound reaches the k-th
best score. Scores are integers made from statistics over all documents, so the shards' lists merge exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable
from .common import MEMO, bounded, mixed, only, raw

#: Postings of one shard, terms of all items answered in one pass, and bits of the filter for terms asked for.
SHARD, ASKED, BITS = 1_000_000, 500_000, 1 << 22
#: Intervals split together, and documents of an interval that is scored whole instead of being split further.
WAVE, LEAF = 32, 48
#: One shard in so many is searched first; its k-th best score is a bound for all others.
FIRST = 16

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def terms_of(text: object) -> list[bytes]:
    """Terms of a whole text: runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z lower-cased."""
    return raw(text).translate(_FOLD).split()


class _Asked(dict):
    """Whether a term may be asked for, by a filter of fixed size; a worker forgets its memo beyond ``MEMO`` terms."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        if len(self) >= MEMO:
            self.clear()
        at = xxhash.xxh3_64_intdigest(term) % BITS
        self[term] = seen = bool(self.bits[at >> 3] >> (at & 7) & 1)
        return seen


def _item_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        bags = [Counter(terms_of(t)) for t in f["text"]]
        size = [len(b) for b in bags]
        flat = [t for b in bags for t in b]
        yield pd.DataFrame(
            {
                "item": np.repeat(f["item"].to_numpy(), size),
                "term": [t.decode("utf-8", "replace") for t in flat],
                "bit": [xxhash.xxh3_64_intdigest(t) % BITS for t in flat],
                "times": [n for b in bags for n in b.values()],
            }
        )


def _documents(bits: np.ndarray):
    """Per document its number of terms, and terms that may be asked for with their occurrences; ``salt`` deals rows evenly."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, at = _Asked(bits), TaskContext.get().partitionId() << 40
        for f in bounded(frames):
            size, terms, times = [], [], []
            for t in f["text"]:
                words = terms_of(t)
                bag = [(w, n) for w, n in Counter(words).items() if asked[w]]
                size.append(len(words))
                terms.append([w.decode("utf-8", "replace") for w, _ in bag])
                times.append([n for _, n in bag])
            salt = mixed(np.arange(at, at + len(f), dtype=np.uint64)).view(np.int64)
            at += len(f)
            yield pd.DataFrame({"doc_id": f["doc_id"], "salt": salt, "n": size, "terms": terms, "times": times})

    return rows


def _index(docs: int, terms: int):
    """One row for each shard: its documents, its vocabulary and its postings by term, as packed arrays."""

    def rows(f: pd.DataFrame) -> pd.DataFrame:
        many = np.fromiter(map(len, f["terms"]), np.int64, len(f))
        code, names = pd.factorize(np.concatenate([*f["terms"], np.array([], object)]), sort=True)
        code, name_of = code.astype(np.int64), np.asarray(names, object)
        times = np.concatenate([*f["times"], np.array([], np.int64)]).astype(np.int64)
        owner = np.repeat(np.arange(len(f)), many)
        # documents of one language and copies of each other stand together: by commonest term, then by least hash
        often = np.bincount(code, minlength=len(name_of))
        hashed = mixed(np.arange(len(name_of), dtype=np.uint64))
        start = np.r_[0, np.cumsum(many)[:-1]]
        full = many > 0
        rank = np.argsort(np.argsort(-often, kind="stable"), kind="stable") if len(often) else often
        main, low = np.zeros(len(f), np.int64), np.zeros(len(f), np.uint64)
        if full.any():
            main[full] = np.minimum.reduceat(rank[code], start[full])
            low[full] = np.minimum.reduceat(hashed[code], start[full])
        lost = f["doc_id"].isna().to_numpy()
        ids = f["doc_id"].fillna(0).to_numpy(np.int64)
        order = np.lexsort((ids, lost, low, main))
        place = np.empty(len(f), np.int64)
        place[order] = np.arange(len(f))
        n = f["n"].to_numpy(np.int64)
        m = 100 - 75 + (75 * n * docs) // max(1, terms)
        impact = (1_000_000_000 * times) // (1000 * times + 8 * m[owner])
        by = np.lexsort((place[owner], code))
        packed = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
        return pd.DataFrame(
            {
                "salt": [int(f["salt"].iloc[0])],
                "ids": [packed(ids[order], "<i8")],
                "lost": [packed(lost[order], "u1")],
                "names": [name_of.tolist()],
                "ends": [packed(np.cumsum(often), "<i4")],
                "docs": [packed(place[owner][by], "<i4")],
                "impact": [packed(impact[by], "<i4")],
            }
        )

    return rows


def _argmax_table(x: np.ndarray, widest: int) -> np.ndarray:
    """Sparse table: row j holds, for each place, the place of the first greatest of the 2^j values from there on."""
    levels = max(1, int(widest).bit_length())
    out = np.empty((levels, max(1, len(x))), np.int32)
    out[0] = np.arange(out.shape[1])
    for j in range(1, levels):
        half = 1 << (j - 1)
        out[j] = out[j - 1]
        a, b = out[j - 1, : max(0, len(x) - half)], out[j - 1, half:]
        out[j, : len(a)] = np.where(x[a] >= x[b], a, b)
    return out


class Shard:
    """Postings of one shard under a sparse table of range maxima."""

    def __init__(self, ids: bytes, lost: bytes, names: list[str], ends: bytes, docs: bytes, impact: bytes):
        self.ids, self.lost = np.frombuffer(ids, "<i8"), np.frombuffer(lost, "u1").astype(bool)
        self.of = {t: i for i, t in enumerate(names)}
        self.ends = np.frombuffer(ends, "<i4").astype(np.int64)
        self.starts = np.r_[0, self.ends[:-1]]
        self.docs = np.frombuffer(docs, "<i4").astype(np.int64)
        self.impact = np.frombuffer(impact, "<i4").astype(np.int64)
        self.count = len(self.ids)
        size = self.ends - self.starts
        self.key = np.repeat(np.arange(len(names)), size) * self.count + self.docs
        self.table = _argmax_table(self.impact, int(size.max(initial=1)))
        by_id = np.lexsort((self.ids, self.lost))
        self.place = np.empty(self.count, np.int64)  # place of each document in the order of ids
        self.place[by_id] = np.arange(self.count)
        self.least = _argmax_table(-self.place, self.count)

    @staticmethod
    def _level(width: np.ndarray) -> np.ndarray:
        return np.frexp(width.astype(np.float64))[1] - 1

    def greatest(self, a: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Places of the greatest impact in the posting ranges [a, e); -1 where a range is empty."""
        some = e > a
        j = self._level(np.where(some, e - a, 1))
        left = np.where(some, a, 0)
        x, y = self.table[j, left], self.table[j, np.where(some, e - (1 << j), 0)]
        return np.where(some, np.where(self.impact[x] >= self.impact[y], x, y), -1)

    def first_place(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least place in the order of ids among documents [lo, hi)."""
        j = self._level(np.maximum(hi - lo, 1))
        return np.minimum(self.place[self.least[j, lo]], self.place[self.least[j, hi - (1 << j)]])

    def top(self, names: list[str], weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best documents with a score above 0 and at least ``floor``, equal scores by id, and their scores."""
        at = np.array([self.of.get(t, -1) for t in names], np.int64)
        weight, at = weight[at >= 0], at[at >= 0]
        weight, at = weight[weight > 0], at[weight > 0]
        best, score = np.array([], np.int64), np.array([], np.int64)
        if not len(at):
            return best, score
        # the pool of open intervals: documents, each term's posting range and place of its greatest impact, bound
        lo, hi = np.array([0]), np.array([self.count])
        a, e = self.starts[at][None, :], self.ends[at][None, :]
        peak = self.greatest(a, e)
        part = np.where(peak >= 0, weight * self.impact[peak], 0)
        bound = part.sum(axis=1)
        least = max(1, floor)
        while len(lo):
            if len(best) == k and score[-1] >= least:
                least = int(score[-1])
                open_ = bound > least
                tie = np.flatnonzero(bound == least)
                if len(tie):
                    open_[tie] = self.first_place(lo[tie], hi[tie]) < self.place[best[-1]]
            else:
                open_ = bound >= least
            if not open_.all():
                lo, hi, a, e, peak, part, bound = (x[open_] for x in (lo, hi, a, e, peak, part, bound))
                if not len(lo):
                    break
            take = np.argpartition(-bound, WAVE - 1)[:WAVE] if len(bound) > WAVE else np.arange(len(bound))
            small = hi[take] - lo[take] <= LEAF
            found, worth = [best], [score]
            if small.any():
                d, s = self._whole(lo[take[small]], hi[take[small]], a[take[small]], e[take[small]], weight)
                found.append(d), worth.append(s)
            cut = take[~small]
            made: tuple[np.ndarray, ...] | None = None
            if len(cut):
                rows = np.arange(len(cut))
                doc = self.docs[peak[cut, part[cut].argmax(axis=1)]]
                p = np.searchsorted(self.key, at[None, :] * self.count + doc[:, None])
                p = np.clip(p, a[cut], e[cut])
                hit = (p < e[cut]) & (self.docs[np.minimum(p, len(self.docs) - 1)] == doc[:, None])
                found.append(doc)
                worth.append(np.where(hit, weight * self.impact[np.minimum(p, len(self.docs) - 1)], 0).sum(axis=1))
                new_lo, new_hi = np.r_[lo[cut], doc[rows] + 1], np.r_[doc[rows], hi[cut]]
                new_a, new_e = np.concatenate([a[cut], p + hit]), np.concatenate([p, e[cut]])
                some = new_hi > new_lo
                new_lo, new_hi, new_a, new_e = (x[some] for x in (new_lo, new_hi, new_a, new_e))
                new_peak = self.greatest(new_a, new_e)
                new_part = np.where(new_peak >= 0, weight * self.impact[new_peak], 0)
                made = (new_lo, new_hi, new_a, new_e, new_peak, new_part, new_part.sum(axis=1))
            rest = np.ones(len(lo), bool)
            rest[take] = False
            pool = tuple(x[rest] for x in (lo, hi, a, e, peak, part, bound))
            lo, hi, a, e, peak, part, bound = (np.concatenate(x) for x in zip(pool, made, strict=True)) if made else pool
            best, score = np.concatenate(found), np.concatenate(worth)
            good = score >= least
            best, score = best[good], score[good]
            order = np.lexsort((self.place[best], -score))[:k]
            best, score = best[order], score[order]
        return best, score

    def _whole(self, lo: np.ndarray, hi: np.ndarray, a: np.ndarray, e: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents of small intervals and their scores."""
        width = hi - lo
        first = np.r_[0, np.cumsum(width)[:-1]]
        docs = np.arange(int(width.sum())) + np.repeat(lo - first, width)
        many = (e - a).ravel()
        cell = np.repeat(np.arange(len(many)), many)
        at = np.arange(int(many.sum())) + np.repeat(a.ravel() - np.r_[0, np.cumsum(many)[:-1]], many)
        row, term = np.divmod(cell, a.shape[1])
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, self.docs[at] - lo[row] + first[row], weight[term] * self.impact[at])
        return docs, score


def _answers(asked: list[tuple[int, list[str], list[int], int]], k: int):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                shard = Shard(r.ids, r.lost, list(r.names), r.ends, r.docs, r.impact)
                out = []
                for item, names, weight, floor in asked:
                    best, score = shard.top(names, np.array(weight, np.int64), k, floor)
                    out += [(item, None if shard.lost[d] else int(shard.ids[d]), int(s)) for d, s in zip(best, score, strict=True)]
                got = pd.DataFrame(out, columns=["item", "doc_id", "score"])
                got["doc_id"] = got["doc_id"].astype("Int64")
                yield got

    return rows


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items(item_id, text)`` the ``k`` best rows of ``docs(doc_id, text)``.

    A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` over all documents with a term; a score sums integer impacts.
    Equal scores go to the smaller doc_id, a null doc_id last. Rows that repeat a doc_id are ranked on their own; items
    equal in id and text are one, and a null item_id is an id like any other. A null text has no terms: such an item, and one
    whose terms occur nowhere, has no result; neither has anything where a table is empty. Other columns are ignored.
    The index of a shard is made once and stored; items come in blocks of at most some ``ASKED`` terms, each of which
    is sent to all shards: first to one in ``FIRST``, whose k-th best scores bound the search in the others.
    """
    named = durable(only(items, ["item_id", "text"]).distinct().withColumn("item", F.monotonically_increasing_id()))
    asked = durable(named.select("item", "text").mapInPandas(_item_terms, "item long, term string, bit int, times long"))
    bits = np.zeros(BITS >> 3, np.uint8)
    marks = np.array([r.bit for r in asked.select("bit").distinct().collect()], np.int64)  # BITS of them at most
    np.bitwise_or.at(bits, marks >> 3, (1 << (marks & 7)).astype(np.uint8))
    held = durable(only(docs, ["doc_id", "text"]).mapInPandas(_documents(bits), "doc_id long, salt long, n long, terms array<string>, times array<long>"))
    size = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.sum(F.size("terms")).alias("postings")).first()
    shards = 1 + (size["postings"] or 0) // SHARD
    index = durable(
        held.where("n > 0").groupBy(F.pmod("salt", F.lit(shards)).alias("shard"))
        .applyInPandas(_index(size["docs"] or 0, size["terms"] or 0), "salt long, ids binary, lost binary, names array<string>, ends binary, docs binary, impact binary")
        .withColumn("first", F.pmod("salt", F.lit(shards)) % FIRST == 0)
    )
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * (size["docs"] or 0) + 2) / (2 * F.col("df") + 1)))
    weighed = asked.join(df, "term").select("item", "term", (F.col("times") * weight).alias("w"))
    many = asked.count()
    ready = durable(
        weighed.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("t"))
        .select("item", F.col("t.term").alias("terms"), F.col("t.w").alias("weights"), F.pmod(F.xxhash64("item"), F.lit(1 + many // ASKED)).alias("block"))
    )

    def searched(block: int) -> DataFrame:
        rows = ready.where(F.col("block") == block).select("item", "terms", "weights").collect()
        found = "item long, doc_id long, score long"
        first = durable(index.where("first").mapInPandas(_answers([(*r, 0) for r in rows], k), found))
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        floors = {r.item: r.score for r in first.withColumn("at", place).where(F.col("at") == k).collect()}  # one an item of this block
        rest = index.where("NOT first").mapInPandas(_answers([(*r, floors.get(r.item, 0)) for r in rows], k), found)
        return first.unionByName(rest)

    parts = [searched(b) for b in range(1 + many // ASKED)]
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
