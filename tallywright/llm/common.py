"""What several operators of this subpackage share: word hashes, row keys, mixing of 64-bit values."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are maximal runs of other characters than these; on UTF-8 bytes that is what ``bytes.split()`` does.
WORD = r"[^\x20\x09-\x0D]+"

#: A worker forgets its memo beyond this many entries, so that memory stays bounded at any vocabulary.
MEMO = 100_000

#: Characters of texts that a task works on at once; what it makes of them goes back to Spark before it goes on.
CHARS_AT_ONCE = 1 << 20


class WordHashes(dict):
    """64-bit hash of a word's bytes, kept for words seen before by this worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(width if n > 0 else 0):
        total = mixed(total + words[i : i + n] + np.uint64(0x9E3779B97F4A7C15))
    return total


def raw(text: object) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def bounded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in frames of about ``CHARS_AT_ONCE`` characters of ``text`` and one more text at most."""
    for f in frames:
        size = np.fromiter((len(t) if isinstance(t, str) else 0 for t in f["text"]), np.int64, len(f))
        part = np.cumsum(size) // CHARS_AT_ONCE
        cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(f)]
        for a, e in zip(cut, cut[1:]):
            yield f.iloc[a:e]


def text_key(text: str = "text") -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def only(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns an operator needs; others may have any name without clashing."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def carried(df: DataFrame, needed: Sequence[str], replaced: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """The needed columns with all others of the caller in one struct, and the columns that restore their order.

    Inside an operator no name of the caller can clash then. Columns that the operator makes itself are left out.
    """
    made = {c.lower() for c in replaced}
    names = [c for c in df.columns if c.lower() not in made]
    rest = [F.col(f"`{c}`") for c in names if c not in needed]
    inner = df.select(*[F.col(f"`{c}`") for c in needed], (F.struct(*rest) if rest else F.lit(0)).alias("_row"))
    return inner, [F.col(c) if c in needed else F.col(f"_row.`{c}`").alias(c) for c in names]
