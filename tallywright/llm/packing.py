"""Packing of token pieces into as few sequences as possible, by a linear program over the length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable
from .common import only
from .tokens import pieces

SEQUENCE, END = 2048, 0
#: Rounds of multiplicative weights, and how fast a covered length loses weight.
ROUNDS, RATE = 700, 0.7


def priced(lengths: np.ndarray, worth: np.ndarray, room: int) -> dict[int, int]:
    """Knapsack by dynamic programming: the set of lengths (index: copies) of greatest worth that fits."""
    best, take = np.zeros(room + 1), np.full(room + 1, -1)
    until = np.searchsorted(lengths, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if k := until[c]:
            all_ = best[c - lengths[:k]] + worth[:k]
            i = int(all_.argmax())
            if all_[i] > best[c] + 1e-15:
                best[c], take[c] = all_[i], i
    made: dict[int, int] = {}
    while room > 0:
        if (i := int(take[room])) < 0:
            room -= 1
            continue
        made[i] = made.get(i, 0) + 1
        room -= int(lengths[i])
    return made


def configurations(counts: dict[int, int], room: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """``(sequences, {length: copies})`` that hold every piece of a length histogram; few sequences in all.

    The configuration program (least number of sequences so that every length is covered as often as it occurs) is solved
    by multiplicative weights: a length's price starts at its share of a sequence and falls as it gets
    covered; dynamic programming finds the best paid configuration. Its amounts are rounded down; what they leave uncovered
    is placed best-fit decreasing, by the histogram. Time and memory depend on ``room`` alone.
    """
    left = {n: c for n, c in counts.items() if n < room}
    out = [(counts[room], {room: 1})] if counts.get(room) else []
    if left:
        lengths = np.array(sorted(left))
        need = np.array([left[n] for n in lengths], float)
        worth, covered = lengths / room, np.zeros(len(lengths))
        found: dict[tuple, float] = {}
        for _ in range(min(ROUNDS, 3 * len(lengths))):
            made = priced(lengths, np.where(covered < 1, worth, 0), room)
            kinds = np.array(list(made), int)
            copies = np.array(list(made.values()))
            if not len(kinds) or (lengths[kinds] * copies).sum() < room:
                break  # no full sequence is left at these prices; the rest is for best fit
            amount = (need[kinds] * np.maximum(0, 1 - covered[kinds]) / copies).min()
            amount = max(amount / 2, min(amount, 1.0))
            covered[kinds] += amount * copies / need[kinds]
            worth[kinds] *= np.exp(-RATE * amount * copies / need[kinds])
            key = tuple(sorted((int(lengths[k]), int(c)) for k, c in zip(kinds, copies, strict=True)))
            found[key] = found.get(key, 0) + amount
        for key, amount in found.items():
            many = min(int(amount + 1e-9), *(left[n] // c for n, c in key))
            if many:
                out.append((many, dict(key)))
                for n, c in key:
                    left[n] -= many * c
    return out + _best_fit(left, room)


def _best_fit(left: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing on counts: sequences with equal content are handled together."""
    open_: list[dict[tuple, int]] = [{} for _ in range(room + 1)]  # by free space: content -> sequences
    for n in sorted((k for k, c in left.items() if c), reverse=True):
        todo = left[n]
        for free in range(n, room):
            again = free
            while todo and again >= n and open_[again]:  # the tightest one takes pieces until it is too full
                content, many = open_[again].popitem()
                used = min(many, todo)
                if many > used:
                    open_[again][content] = many - used
                fits = min(again // n, todo // used)
                grown = (*content, (n, fits))
                rest = again - fits * n
                open_[rest][grown] = open_[rest].get(grown, 0) + used
                todo -= fits * used
        per = room // n
        for copies in (per, todo % per):
            many = todo // per if copies == per else (1 if copies else 0)
            if many:
                key = ((n, copies),)
                open_[room - copies * n][key] = open_[room - copies * n].get(key, 0) + many
            todo -= many * copies
    merged = []
    for group in open_:
        for content, many in group.items():
            made: dict[int, int] = {}
            for n, c in content:
                made[n] = made.get(n, 0) + c
            merged.append((many, made))
    return merged


def slots(made: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, runs of places: first rank, first sequence, copies in a sequence, offset of the first copy."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for many, content in made:
        offset = 0
        for n, copies in content.items():
            rows.setdefault(n, []).append((used.get(n, 0), first, copies, offset))
            used[n] = used.get(n, 0) + many * copies
            offset += n * copies
        first += many
    return {n: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for n, r in rows.items()}


def _cut(path: str | None, room: int, with_ids: bool):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own, part = pieces(path), TaskContext.get().partitionId()
        before = np.zeros(room + 1, np.int64)
        end = np.array([END], "<u4").tobytes()
        for f in frames:
            out = []
            for d, t in zip(f["doc_id"], f["text"], strict=True):
                ids = own.ids(t) + end
                for piece, at in enumerate(range(0, len(ids), 4 * room)):
                    data = ids[at : at + 4 * room]
                    n = len(data) // 4
                    out.append((d, piece, at // 4, n, zlib.crc32(data), part, before[n], data if with_ids else None))
                    before[n] += 1
            got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"])
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return rows


def _placed(table: dict[int, tuple[np.ndarray, ...]]):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sequence, offset = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            for n, at in f.groupby("length").indices.items():
                rank = f["rank"].to_numpy()[at]
                start, first, copies, base = table[n]
                k = np.searchsorted(start, rank, "right") - 1
                which, copy = np.divmod(rank - start[k], copies[k])
                sequence[at], offset[at] = first[k] + which, base[k] + copy * n
            yield f.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    return rows


def packed(docs: DataFrame, room: int = SEQUENCE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``, little-endian 32-bit) per piece.

    A document is its ids and ``END``; one longer than ``room`` is cut. A piece's place follows from its rank among
    pieces of its length: counts by task, added up before it, and its number in its task. Only the
    histogram (``room`` numbers at most) comes to the driver, only the configurations go back. A null or empty text is
    the end alone; repeated rows are documents of their own; no rows give no sequence. Other columns are ignored.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"
    cut = durable(only(docs, ["doc_id", "text"]).mapInPandas(_cut(path, room, with_ids), fields))
    by_task = durable(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("many")))
    counts = {r.length: r.many for r in by_task.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    table = slots(configurations(counts, room))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_task.select("part", "length", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("shift"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = cut.join(shift, ["part", "length"]).select(*names, (F.col("nth") + F.col("shift")).alias("rank"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids
    return ranked.mapInPandas(_placed(table), kinds + "sequence_id long, offset long")
