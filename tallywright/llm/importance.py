"""Importance resampling towards a target distribution, over hashed word features.

Buckets are CRC-32 checksums of features, made for all features of many texts at once: a byte contributes a value that
depends only on itself and on its distance from the feature's end, and those of one feature are combined by exclusive or.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import global_rank
from ..runtime import durable
from .common import bounded, only, raw

#: Distances from the end that the position table covers; longer features are folded in blocks of so many bytes.
REACH = 32
_POLY = np.uint32(0xEDB88320)

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def _step_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ _POLY, x >> np.uint32(1))
    return x


_STEP = _step_table()


def _position_table() -> np.ndarray:
    """Row d: what each byte contributes when d bytes follow it in its feature."""
    rows = [_STEP]
    for _ in range(1, REACH):
        rows.append((rows[-1] >> np.uint32(8)) ^ _STEP[rows[-1] & 255])
    return np.stack(rows)


POSITION = _position_table()
#: Checksum of so many zero bytes: what the initial and the final inversion add, by length.
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _moved(width: int) -> np.ndarray:
    """Tables (4 x 256) that move a state on by ``width`` zero bytes, one for each of its bytes."""
    x = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    for _ in range(width):
        x = (x >> np.uint32(8)) ^ _STEP[x & 255]
    return x


def _through(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    parts = [tables[i][(x >> np.uint32(8 * i)) & 255] for i in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


_FIRST_MOVE = _moved(REACH)


def _flat(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All numbers of ranges ``start, start + 1, ...`` of the given lengths, one range after the other."""
    return np.arange(int(many.sum())) + np.repeat(start - np.r_[0, np.cumsum(many)[:-1]], many)


def checksums(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """CRC-32 of each span ``data[start:stop]`` of bytes; spans are not empty and may overlap."""
    if not len(start):
        return np.array([], np.uint32)
    size = stop - start
    blocks = -(-size // REACH)  # block 0 ends where the span ends, only the last one may be shorter
    owner = np.repeat(np.arange(len(start)), blocks)
    index = _flat(np.zeros(len(start), np.int64), blocks)
    high = stop[owner] - REACH * index
    low = np.maximum(start[owner], high - REACH)
    many = high - low
    at = _flat(low, many)
    first = np.r_[0, np.cumsum(many)[:-1]]
    part = np.bitwise_xor.reduceat(POSITION[np.repeat(high, many) - 1 - at, data[at]], first)
    move = _FIRST_MOVE
    while len(part) > len(start):  # pairs of blocks become one of twice the width
        odd = index & 1 == 1
        lower = np.flatnonzero(odd) - 1  # its neighbour nearer to the end stands right before it
        part[lower] ^= _through(move, part[odd])
        part, index = part[~odd], index[~odd] >> 1
        move = np.stack([_through(move, t) for t in move])
    out = part ^ LENGTH[np.minimum(size, REACH)]
    for n in np.unique(size[size > REACH]):
        same = size == n
        out[same] = part[same] ^ np.uint32(zlib.crc32(bytes(int(n))))
    return out


def features(texts: list[object], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and text and bucket of each feature: all runs of 1 to ``width`` words, joined by one space."""
    words = [raw(t).translate(_FOLD).split() for t in texts]
    per = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b" ".join([b" ".join(w) for w in words if w]), np.uint8)
    size = np.fromiter((len(w) for ws in words for w in ws), np.int64, int(per.sum()))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    owner = np.repeat(np.arange(len(words)), per)
    texts_, spans = [], []
    for n in range(1, width + 1):
        first = np.arange(max(0, len(start) - n + 1))
        first = first[owner[first] == owner[first + n - 1]]
        texts_.append(owner[first])
        spans.append(checksums(data, start[first], stop[first + n - 1]))
    return per, np.concatenate(texts_), (np.concatenate(spans) % np.uint32(buckets)).astype(np.int64)


def _counts(width: int, buckets: int):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(buckets, np.int64)
        for f in bounded(frames):
            seen += np.bincount(features(f["text"].tolist(), width, buckets)[2], minlength=buckets)
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": some, "times": seen[some]})

    return rows


def _weights(gain: np.ndarray, width: int):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in bounded(frames):
            words, owner, bucket = features(f["text"].tolist(), width, len(gain))
            total = np.zeros(len(f), np.int64)
            np.add.at(total, owner, gain[bucket])
            many = np.bincount(owner, minlength=len(f)).astype(np.int64)
            yield pd.DataFrame({"doc_id": f["doc_id"], "words": words, "n_features": many, "weight": total})

    return rows


def bucket_counts(texts: DataFrame, width: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; each task hands on at most one row a bucket, and the result has ``buckets`` numbers."""
    rows = texts.select("text").mapInPandas(_counts(width, buckets), "bucket long, times long").groupBy("bucket").agg(F.sum("times").alias("times"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():
        out[r.bucket] = r.times
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(p_target / p_source))`` of each bucket, one added to every count."""
    m = len(source)
    up = (target + 1.0) * (float(source.sum()) + m)
    down = (source + 1.0) * (float(target.sum()) + m)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def resampled(
    docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs(doc_id, text)``; drawn rows have a rank.

    A feature's gain is its bucket's log ratio in ``target(text)`` to ``docs``; a document's weight sums its features' gains, and
    a Gumbel value made from ``seed`` and doc_id makes the ``percent`` highest scores of documents with at least
    ``least_words`` words a draw without replacement. Ties go to the smaller doc_id, null last. A null text has no
    words: no features, weight 0, never drawn. A null doc_id hashes as the empty string. Rows that repeat are scored and
    drawn on their own. An empty target leaves all gains to the smoothing; empty ``docs`` give no rows. Other columns are ignored.
    """
    rows = only(docs, ["doc_id", "text"])
    gain = gains(bucket_counts(rows, width, buckets), bucket_counts(only(target, ["text"]), width, buckets))
    weighed = rows.mapInPandas(_weights(gain, width), "doc_id long, words long, n_features long, weight long")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = durable(weighed.withColumn("score", F.col("weight") + noise).withColumn("at", F.monotonically_increasing_id()))
    able = F.col("words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("at")]
    placed = global_rank(scored.where(able).select("doc_id", "n_features", "weight", "score", "at"), order)
    names = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~able).select(*names, F.lit(None).cast("long").alias("rank"))
    )
