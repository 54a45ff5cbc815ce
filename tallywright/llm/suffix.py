"""Removal of repeated byte strings with suffix arrays made by induced sorting, one per shard.

Every window of ``WINDOW`` bytes is assigned to its anchor, the 32-gram of smallest hash in it: equal windows have
the same anchor at the same place. Consecutive windows of one anchor form a cell. Only cells whose anchor occurs
again can hold a repeat; equal cells are counted as one class by Spark, and where an anchor has several classes
a shard's suffix array over their bytes finds the windows they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .common import bounded, mixed, only, raw, text_key

WINDOW, GRAM = 100, 32
#: Windows looked at together in one text; cells end there, longer texts are cut at no other cost.
SEGMENT = 1 << 18
#: Bytes of cells in one suffix array.
SHARD = 1_000_000
#: An anchor with more classes than this is dealt by window instead of by anchor, so no task holds all of it.
HOT = 8_192


# --- suffix array of one shard ---------------------------------------------------------------------------------


def _deal(sa: np.ndarray, at: np.ndarray, chars: np.ndarray, items: np.ndarray, step: int) -> None:
    """Put items into their buckets in the order given; ``at`` holds each bucket's next free place."""
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    starts = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
    many = np.diff(np.r_[starts, len(chars)])
    inside = np.arange(len(chars), dtype=np.int32) - np.repeat(starts, many)
    sa[at[chars] + step * inside] = items[order]
    at[chars[starts]] += step * many


def _induce(s: np.ndarray, small: np.ndarray, ends: np.ndarray, lms: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Suffix array induced from ``lms``, the leftmost-smaller suffixes in bucket order given.

    Buckets are taken in order of their character; inside one, everything already known induces its
    predecessors together, wave by wave, so each suffix is handled once per pass.
    """
    n = len(s)
    sa = np.full(n, -1, np.int32)
    heads, n_small = np.r_[0, ends[:-1]], np.bincount(s[small], minlength=len(ends))
    split = ends - n_small  # larger suffixes (L) of a bucket stand before its smaller ones (S)
    per = np.bincount(s[lms], minlength=len(ends))
    lms_at = np.r_[0, np.cumsum(per)]
    at = heads.copy()
    for c in present:  # larger suffixes, from the left
        done = heads[c]
        while done < at[c]:
            wave = sa[done : at[c]] - 1
            done = at[c]
            wave = wave[wave >= 0]
            wave = wave[~small[wave]]
            if len(wave):
                _deal(sa, at, s[wave], wave, 1)
        own = lms[lms_at[c] : lms_at[c + 1]] - 1
        own = own[own >= 0]
        if len(own):
            _deal(sa, at, s[own], own, 1)
    at = ends - 1
    sa[0], at[s[-1]] = n - 1, at[s[-1]] - 1  # the end is induced by nothing
    for c in present[::-1]:  # smaller suffixes, from the right
        done = ends[c] - 1
        while done > at[c]:
            wave = sa[at[c] + 1 : done + 1][::-1] - 1
            done = at[c]
            wave = wave[wave >= 0]
            wave = wave[small[wave]]
            if len(wave):
                _deal(sa, at, s[wave], wave, -1)
        wave = sa[heads[c] : split[c]][::-1] - 1
        wave = wave[wave >= 0]
        wave = wave[small[wave]]
        if len(wave):
            _deal(sa, at, s[wave], wave, -1)
    return sa


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of integers whose last one is the smallest and occurs once.

    Suffixes are classified as larger (L) or smaller (S) than their successor. Leftmost smaller substrings are
    sorted by induction and named; if names repeat, the string of names is sorted by recursion while its alphabet
    is small, else by doubling of the names (a bucket pass over many thousand characters has nothing to do
    at once). One more induction gives the array.
    """
    n = len(s)
    if n < 3:
        return np.argsort(s, kind="stable")
    step = np.sign(np.diff(s))
    last = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))  # equal neighbours follow the next different pair
    last = np.minimum.accumulate(last[::-1])[::-1]
    small = np.r_[step[np.minimum(last, n - 2)] > 0, True]
    is_lms = np.r_[False, small[1:] & ~small[:-1]]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    ends = np.cumsum(np.bincount(s))
    present = np.flatnonzero(np.diff(np.r_[0, ends]))
    by_char = lms[np.argsort(s[lms], kind="stable")]
    if len(lms) > 1:
        sa = _induce(s, small, ends, by_char, present)
        order = sa[is_lms[sa]]  # the substrings, sorted
        length = np.zeros(n, np.int32)
        length[lms] = np.diff(np.r_[lms, n - 1])
        a, b = order[:-1], order[1:]
        new = length[a] != length[b]
        open_ = np.flatnonzero(~new)
        for off in range(int(length[order].max()) + 1):
            open_ = open_[length[a[open_]] >= off]
            if not len(open_):
                break
            differ = s[a[open_] + off] != s[b[open_] + off]
            new[open_[differ]] = True
            open_ = open_[~differ]
        name = np.zeros(n, np.int32)
        name[order] = np.r_[0, np.cumsum(new)]
        names = name[lms]
        if names.max() + 1 == len(names):
            lms = order
        elif names.max() < 1024:
            lms = lms[suffix_array(names)]
        else:
            lms = lms[_doubled(names)]
        by_char = lms[np.argsort(s[lms], kind="stable")]
    return _induce(s, small, ends, by_char, present)


def _doubled(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, comparing twice as many names in each round."""
    n, width, rank = len(rank), 1, rank.astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[0, np.cumsum(key[1:] != key[:-1])]
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


def _words8(b: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place, as one number."""
    x = b.astype(np.uint64)
    for half in (1, 2, 4):
        x = x[:-half] | (x[half:] << np.uint64(8 * half))
    return x


def common_prefixes(b: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: for each place of the text, bytes shared with the suffix before it in ``sa``, up to ``cap``."""
    before = np.full(len(b), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = _words8(np.r_[b, np.zeros(cap + 8, b.dtype)])
    out = np.zeros(len(b), np.int32)
    i = np.flatnonzero(before >= 0)
    for off in range(0, cap, 8):
        j = before[i]
        differ = padded[i + off] ^ padded[j + off]
        same = differ == 0
        part = i[~same]
        low = differ[~same]
        out[part] = off + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int32) // 8
        i = i[same]
    out[i] = cap
    return np.minimum(out, np.minimum(cap, len(b) - np.maximum(np.arange(len(b), dtype=np.int32), before)))


def repeated_windows(cells: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each cell the starts of windows that also start at an earlier place of this list."""
    length = np.array([len(c) for c in cells])
    starts = np.cumsum(length + 1) - length - 1
    text = np.zeros(int(length.sum()) + len(cells) + 1, np.int32)
    b = np.zeros(len(text), np.uint8)
    left = np.zeros(len(text), np.int32)
    for at, c in zip(starts, cells, strict=True):
        b[at : at + len(c)] = np.frombuffer(c, np.uint8)
        text[at : at + len(c)] = b[at : at + len(c)].astype(np.int32) + 2
        left[at : at + len(c)] = np.arange(len(c), 0, -1)
        text[at + len(c)] = 1
    sa = suffix_array(text)
    shared = common_prefixes(b, sa, window)
    full = sa[left[sa] >= window]  # suffixes between two that share a window share it too
    run = np.cumsum(np.r_[True, shared[full[1:]] < window]) if len(full) else np.array([], int)
    heads = np.flatnonzero(np.r_[True, np.diff(run) > 0]) if len(full) else np.array([], int)
    again = np.zeros(len(text), bool)
    if len(full):
        first = np.minimum.reduceat(full, heads)
        again[full[full != first[run - 1]]] = True
    return [np.flatnonzero(again[at : at + n]) for at, n in zip(starts, length, strict=True)]


# --- anchors and cells -----------------------------------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def cells(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per segment of a text: first window, number of windows and anchor of each cell."""
    grams = WINDOW - GRAM + 1
    for base in range(0, len(data) - WINDOW + 1, SEGMENT):
        b = np.frombuffer(data, np.uint8)[base : base + SEGMENT + WINDOW - 1]
        x = _words8(b)
        many, h = len(b) - GRAM + 1, np.uint64(GRAM)
        for off in range(0, GRAM, 8):
            h = mixed(h + x[off : off + many])
        key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(key, grams) & np.uint64(0xFFFFFF)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        yield base + start, np.diff(np.r_[start, len(at)]), h[at[start]]


def _anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        found = [h for t in f["text"] for _, _, h in cells(raw(t))]
        yield pd.DataFrame({"anchor": np.concatenate([*found, np.array([], np.uint64)]).view(np.int64)})


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        parts = []
        for d, k, t in zip(f["doc_id"], f["text_key"], f["text"], strict=True):
            data = raw(t)
            for start, many, h in cells(data):
                body = [xxhash.xxh3_64_intdigest(data[a : a + m + WINDOW - 1]) for a, m in zip(start.tolist(), many.tolist(), strict=True)]
                parts.append((d, k, start, many, h, np.array(body, np.uint64)))
        size = [len(p[2]) for p in parts]
        join = lambda i, kind: np.concatenate([p[i] for p in parts]).astype(kind) if parts else np.array([], kind)
        ids = pd.array([p[0] for p in parts], dtype="Int64") if parts else pd.array([], dtype="Int64")
        yield pd.DataFrame(
            {
                "anchor": join(4, np.uint64).view(np.int64),
                "body": join(5, np.uint64).view(np.int64),
                "doc_id": ids.repeat(size) if parts else ids,
                "text_key": np.repeat(np.array([p[1] for p in parts], np.int64), size),
                "start": join(2, np.int64),
                "many": join(3, np.int32),
            }
        )


def _bytes_of_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        out = []
        for d, k, t, need in zip(f["doc_id"], f["text_key"], f["text"], f["need"], strict=True):
            data = raw(t)
            out += [(d, k, x["anchor"], x["start"], data[x["start"] : x["start"] + x["many"] + WINDOW - 1]) for x in need]
        got = pd.DataFrame(out, columns=["doc_id", "text_key", "anchor", "start", "bytes"])
        got["doc_id"] = got["doc_id"].astype("Int64")
        yield got


def _windows_of_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in bounded(frames):
        out = []
        for d, k, t, need in zip(f["doc_id"], f["text_key"], f["text"], f["need"], strict=True):
            data = raw(t)
            for x in need:
                for s in range(x["start"], x["start"] + x["many"]):
                    out.append((xxhash.xxh3_128_digest(data[s : s + WINDOW]), d, k, s))
        got = pd.DataFrame(out, columns=["window", "doc_id", "text_key", "start"])
        got["doc_id"] = got["doc_id"].astype("Int64")
        yield got


def _spans(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of consecutive window starts as byte spans."""
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > 1)
        yield from zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + WINDOW).tolist(), strict=True)


def _shard(f: pd.DataFrame) -> pd.DataFrame:
    f = f.sort_values(["doc_id", "text_key", "start"], na_position="first")
    out = []
    for d, k, start, found in zip(f["doc_id"], f["text_key"], f["start"], repeated_windows(f["bytes"].tolist()), strict=True):
        out += [(d, k, start + a, start + e) for a, e in _spans(found)]
    got = pd.DataFrame(out, columns=["doc_id", "text_key", "start", "stop"])
    got["doc_id"] = got["doc_id"].astype("Int64")
    return got


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, stop``: byte spans covered by windows that start earlier, for ``docs(doc_id, text, text_key)``."""
    place = F.struct("doc_id", "text_key", "start")
    again = docs.select("text").mapInPandas(_anchors, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    schema = "anchor long, body long, doc_id long, text_key long, start long, many int"
    found = durable(docs.mapInPandas(_cells, schema).join(again.select("anchor"), "anchor", "left_semi"))
    classes = durable(found.groupBy("anchor", "body").agg(F.min(place).alias("at"), F.max("many").alias("many")))
    kinds = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    several = durable(classes.join(kinds, "anchor").select("anchor", "kinds", "at.*", "many"))

    later = (
        found.join(classes.select("anchor", "body", "at"), ["anchor", "body"])
        .where(~place.eqNullSafe(F.col("at")))
        .select("doc_id", "text_key", "start", (F.col("start") + F.col("many") + WINDOW - 1).alias("stop"))
    )

    def with_text(part: DataFrame) -> DataFrame:
        need = part.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(F.collect_list(F.struct("anchor", "start", "many")).alias("need"))
        return docs.join(need, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))).select("doc_id", "text_key", "text", "need")

    size = several.where(F.col("kinds") <= HOT).agg(F.sum(F.col("many") + WINDOW)).first()[0] or 0
    shards = 1 + size // SHARD
    held = with_text(several.where(F.col("kinds") <= HOT)).mapInPandas(
        _bytes_of_cells, "doc_id long, text_key long, anchor long, start long, bytes binary"
    )
    spans = "doc_id long, text_key long, start long, stop long"
    shared = held.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards))).applyInPandas(_shard, spans)
    out = later.unionByName(shared)
    hot = several.where(F.col("kinds") > HOT)
    if not hot.isEmpty():
        windows = durable(with_text(hot).mapInPandas(_windows_of_cells, "window binary, doc_id long, text_key long, start long"))
        first = windows.groupBy("window").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("times")).where("times > 1")
        hit = windows.join(first, "window").where(~place.eqNullSafe(F.col("at")))
        out = out.unionByName(hit.select("doc_id", "text_key", "start", (F.col("start") + WINDOW).alias("stop")))
    return out


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by (start, stop) rows."""
    if not len(spans):
        return []
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    cut = np.flatnonzero(spans[1:, 0] > reach[:-1])
    return list(zip(spans[np.r_[0, cut + 1], 0].tolist(), reach[np.r_[cut, len(spans) - 1]].tolist(), strict=True))


def _removed(with_kept: tuple[str, ...]):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in bounded(frames):
            made = []
            for t, spans in zip(f["text"], f["spans"], strict=True):
                data = raw(t)
                runs = merged(np.array([(x["start"], x["stop"]) for x in spans], np.int64).reshape(-1, 2)) if spans is not None else []
                kept, at = [], 0
                for a, e in runs:
                    kept.append(data[at:a])
                    at = e
                rest = b"".join([*kept, data[at:]])
                whole = {"kept": lambda r=rest: r, "kept_text": lambda r=rest: r.decode("utf-8", "ignore")}  # of characters cut in half nothing stays
                made.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), *[whole[k]() for k in with_kept]))
            got = pd.DataFrame(made, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", *with_kept])
            yield pd.concat([f.drop(columns=["text", "spans"]).reset_index(drop=True), got], axis=1)

    return rows


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = (), with_kept: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the columns in ``keep``; ``with_kept`` asks for ``kept``, the remaining
    bytes, or ``kept_text``, or both.

    Removes every byte covered by a ``WINDOW``-byte string that also starts earlier: in a smaller doc_id (null first), or
    in the same document further left. Rows with one doc_id are ordered by a hash of their text; rows that repeat doc_id
    and text are one document and both get its answer. A null text is empty; texts under ``WINDOW`` bytes lose
    nothing. Strings are judged on the input. Other columns are ignored.
    """
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys(["doc_id", "text", *keep])])
    twice = source.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1 OR doc_id IS NULL")
    source = source.withColumn("text_key", F.lit(0).cast("long") if twice.isEmpty() else text_key())  # nothing to tell apart
    found = repeats(only(source, ["doc_id", "text", "text_key"])).groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    spans = found.agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = source.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left").drop("d", "k", "text_key")
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    names = ["doc_id", *[c for c in keep if c not in ("doc_id", "text")]]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += "".join(f", {k} {'binary' if k == 'kept' else 'string'}" for k in with_kept)
    return joined.select(*[f"`{c}`" for c in names], "text", "spans").mapInPandas(_removed(with_kept), schema)
