"""Jaro-Winkler similarity over Arrow batches (Spark has no built-in)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published definition
BOOST_ABOVE = 0.7
PREFIX_SCALE = 0.1
PREFIX_MAX = 4

_CHUNK = 1024
_PAD_A, _PAD_B, _TAKEN = -1, -2, -3  # codes no character has


def _codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    out = np.full((len(texts), max(int(lengths.max(initial=0)), 1)), pad, dtype=np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out, lengths


def _in_order(codes: np.ndarray, matched: np.ndarray, width: int) -> np.ndarray:
    """Matched characters of each row moved to the front, in their order."""
    out = np.full((len(codes), width), _TAKEN, dtype=np.int32)
    rows, cols = np.nonzero(matched)
    out[rows, (np.cumsum(matched, axis=1) - 1)[rows, cols]] = codes[rows, cols]
    return out


def jaro_winkler(first: list[str], second: list[str]) -> np.ndarray:
    """Similarity of each pair; the whole batch advances one character at a time."""
    shorter = [x if len(x) <= len(y) else y for x, y in zip(first, second)]
    longer = [y if len(x) <= len(y) else x for x, y in zip(first, second)]
    a, la = _codes(shorter, _PAD_A)
    b, lb = _codes(longer, _PAD_B)
    every, at = np.arange(len(la)), np.arange(b.shape[1])[None, :]
    window = np.maximum(lb // 2 - 1, 0)[:, None]
    if (window == window[0]).all():
        window = window[:1]
    free = b.copy()
    hit_a = np.zeros(a.shape, dtype=bool)
    for i in range(a.shape[1]):
        fits = free == a[:, i : i + 1]
        fits &= np.abs(at - i) <= window
        where = fits.argmax(axis=1)
        found = fits[every, where]
        hit_a[:, i] = found
        free[every[found], where[found]] = _TAKEN
    m = hit_a.sum(axis=1)
    width = a.shape[1]
    t = (_in_order(a, hit_a, width) != _in_order(b, free == _TAKEN, width)).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - t) / m) / 3.0, 0.0)
    head = min(PREFIX_MAX, width)
    prefix = np.cumprod(a[:, :head] == b[:, :head], axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_SCALE * (1.0 - jaro), jaro)


def similarities(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rounded similarity of each pair of texts."""
    # pairs of like length share a chunk, so one long text does not widen the others
    order = np.argsort(np.fromiter((max(len(p), len(q)) for p, q in zip(x, y)), np.int64, len(x)), kind="stable")
    out = np.zeros(len(x))
    for start in range(0, len(x), _CHUNK):
        part = order[start : start + _CHUNK]
        out[part] = jaro_winkler(list(x[part]), list(y[part]))
    return np.round(out, 6)


@F.pandas_udf(T.DoubleType())
def jaro_winkler_col(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(similarities(a.fillna("").to_numpy(dtype=object), b.fillna("").to_numpy(dtype=object)))
