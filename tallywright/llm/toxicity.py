"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable, small_side
from .common import only, raw

#: Labelled texts the dictionaries and thresholds are fitted on, at most (bounded, chosen by a hash of the id), and characters of
#: each: of a longer text as many stretches of equal length, spread evenly over it.
TOXIC_TEXTS, ORDINARY_TEXTS = 2000, 4000
FIT_CHARS, STRETCHES = 1 << 16, 16
#: Words of a window; bytes of the dictionary part both sides share, and of the part trained on each side's own text.
WORDS, SHARED_BYTES, OWN_BYTES = 8, 1 << 16, 1 << 13
#: Bytes of text a dictionary is trained on at most, an equal share from each text, spread evenly over it.
TRAINING_BYTES = 1 << 25
#: Bytes of the strings (with the spaces around a word) that mark a word as toxic: so many times rarer in ordinary texts, and
#: so often in toxic ones that chance would give less than one such string.
GRAM, LIFT = 6, 8.0
#: Parts of the labelled texts; gains of a part come from dictionaries of the others when thresholds are calibrated.
FOLDS = 3
#: Bytes that a window gains, counted at each of these edges.
EDGES = (1, 2, 3, 4, 6, 8)
#: Share of all weight that toxic texts have in the calibration; more finds more of them and alarms more often.
TOXIC_WEIGHT = 0.25
#: Start of a trained dictionary, and the offsets its tables end with (fixed by the format).
MAGIC, REPEATS = b"\x37\xa4\x30\xec", b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"
_OTHER = re.compile(rb"[^\w\x80-\xff]+")


def plain(text: object) -> list[bytes]:
    return _OTHER.sub(b" ", raw(text).lower()).split()


def windows(words: list[bytes]) -> list[bytes]:
    return [b" %b " % b" ".join(words[i : i + WORDS]) for i in range(0, len(words), WORDS)]


@dataclass
class Model:
    """Two dictionaries and the calibrated line through a text's features; without both kinds of text, score 0."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4 + 2 * len(EDGES)))

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        how = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=16, hash_log=16, search_log=6, min_match=3, target_length=64,
            strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_dict_id=False,
        )
        made = []
        for data in (self.toxic, self.ordinary):
            own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)
            own.precompute_compress(compression_params=how)
            made.append(zstandard.ZstdCompressor(compression_params=how, dict_data=own))
        return tuple(made)

    def gains(self, both: tuple[zstandard.ZstdCompressor, ...], text: object) -> np.ndarray:
        """Per window, bytes that the toxic dictionary saves over the ordinary one."""
        toxic, ordinary = both
        return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(plain(text))])

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.toxic:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def features(gains: list[np.ndarray]) -> np.ndarray:
    """Per text: windows that gain an edge or more, their share, the greatest gain, the gain of all, and the text's length."""
    rows = []
    for g in gains:
        n, many = max(1, len(g)), [(g >= e).sum() for e in EDGES]
        top = np.sort(g)[-4:].sum() if len(g) else 0
        rows.append((1.0, np.log(n), top / 10, g.sum() / n, *np.log1p(many), *(k / np.sqrt(n) for k in many)))
    return np.array(rows, float).reshape(-1, 4 + 2 * len(EDGES))


def _logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Newton steps on the regularised likelihood, each row with its weight."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (each * (y - p)) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _dictionary(size: int, texts: list[list[bytes]]) -> bytes:
    """Content zstandard's trainer picks from the parts of all texts; too few samples are used as they are."""
    share, samples = max(1, TRAINING_BYTES // max(1, len(texts))), []
    for parts in texts:
        pieces = [t[i : i + 64] for t in parts for i in range(0, len(t), 64) if len(t[i : i + 64]) >= 8]
        samples += pieces[:: max(1, -(-sum(map(len, pieces)) // share))]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:] or b" "


def _grams(word: bytes) -> list[bytes]:
    word = b" %b " % word
    return [word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1))]


def _parts(dictionary: bytes) -> tuple[bytes, bytes]:
    """Coding tables and content of a trained dictionary (the tables end with the three first repeat offsets, RFC 8878)."""
    cut = dictionary.find(REPEATS) + len(REPEATS)
    return (dictionary[:cut], dictionary[cut:]) if dictionary.startswith(MAGIC) and cut >= len(REPEATS) else (b"", dictionary)


def _chance(k: int, times: int, share: float) -> float:
    """Bound (Chernoff's) on the chance that ``k`` or more of ``times`` texts are of a side that has this share of all."""
    seen = k / times
    rest = (1 - seen) * np.log((1 - seen) / (1 - share)) if seen < 1 else 0.0
    return float(np.exp(-times * (seen * np.log(seen / share) + rest)))


def _dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Shared coding tables and content, then a part of each side's own.

    With the tables even a window of few words is coded instead of stored. The toxic part is trained on words with a marking
    string, the ordinary part on the words that resemble those most; both have one length, so shared matches lie equally far
    back, and a gain comes from marked words.
    """
    sides = (toxic, ordinary)
    often = [Counter(g for t in side for g in {g for w in set(t) for g in _grams(w)}) for side in sides]
    n, m = map(len, sides)
    share, kinds = n / (n + m), len(often[0].keys() | often[1].keys())
    more = {g: k for g, k in often[0].items() if (k + 0.5) / (n + 1) >= LIFT * (often[1][g] + 0.5) / (m + 1)}
    marks = {g for g, k in more.items() if _chance(k, k + often[1][g], share) * kinds < 1}
    marked = {w for w in set().union(*toxic) if not marks.isdisjoint(_grams(w))}
    inner = {w[i : i + GRAM] for w in marked for i in range(len(w) - GRAM + 1)}
    alike = {w for w in set().union(*ordinary) if marks.isdisjoint(_grams(w)) and not inner.isdisjoint(_grams(w))}
    own = [
        _parts(_dictionary(OWN_BYTES, [[b" %b " % b" ".join([w for w in t if w in keep])] for t in side]))[1]
        for side, keep in zip(sides, (marked, alike), strict=True)
    ]
    tables, shared = _parts(_dictionary(SHARED_BYTES, [windows(t) for t in ordinary]))
    size = max(map(len, own))
    return tables + shared + own[0].rjust(size, b"\0"), tables + shared + own[1].rjust(size, b"\0")


def trained(toxic: list[str], ordinary: list[str]) -> Model:
    """Fit on two lists of texts.

    Thresholds are calibrated on gains by dictionaries that have not seen the text; ``TOXIC_WEIGHT`` balances the two kinds.
    """
    if not toxic or not ordinary:
        return Model()
    words = [[plain(t) for t in side] for side in (toxic, ordinary)]
    y = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    gains: list[np.ndarray] = [np.array([])] * len(y)
    folds = FOLDS if min(map(len, words)) >= FOLDS else 1
    for fold in range(folds):
        rest = [[t for i, t in enumerate(side) if folds == 1 or i % folds != fold] for side in words]
        part = Model(*_dictionaries(*rest))
        both = part.compressors()
        for side, start in ((toxic, 0), (ordinary, len(toxic))):
            for i in range(fold, len(side), folds):
                gains[start + i] = part.gains(both, side[i])
    model = Model(*_dictionaries(*words))
    model.weights = _logistic(features(gains), y, np.where(y == 1, TOXIC_WEIGHT / len(toxic), (1 - TOXIC_WEIGHT) / len(ordinary)) * len(y))
    return model


def _spread(text: Column) -> Column:
    """The text, or evenly spread stretches of one longer than ``FIT_CHARS``."""
    long, step = FIT_CHARS // STRETCHES, (F.length(text) - FIT_CHARS // STRETCHES) / (STRETCHES - 1)
    parts = [F.substring(text, F.lit(1) + F.floor(step * i).cast("int"), F.lit(long)) for i in range(STRETCHES)]
    return F.when(F.length(text) > FIT_CHARS, F.concat_ws(" ", *parts)).otherwise(text)


def fitted(docs: DataFrame, labels: DataFrame, may_learn: str) -> Model:
    """Model from a bounded sample of labelled doc_ids, one text of each, for which the SQL condition ``may_learn`` holds."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(may_learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    some = known.where("toxic = 1").orderBy(order, "doc_id").limit(TOXIC_TEXTS).union(known.where("toxic <> 1").orderBy(order, "doc_id").limit(ORDINARY_TEXTS))
    side = small_side(durable(some))
    rows = only(docs, ["doc_id", "text"]).join(side, "doc_id").where("text IS NOT NULL").groupBy("doc_id").agg(_spread(F.min("text")).alias("text"), F.max("toxic").alias("toxic"))
    texts = sorted({(r.text, r.toxic) for r in rows.select("text", "toxic").collect()})
    return trained([t for t, k in texts if k == 1], [t for t, k in texts if k != 1])


def _scored(model: Model):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = model.compressors() if model.toxic else None
        for f in frames:
            gains = [model.gains(both, t) if both else np.array([]) for t in f["text"]]
            yield f.drop(columns="text").assign(score=model.score(features(gains)))

    return rows


def toxicity(docs: DataFrame, labels: DataFrame, may_learn: str = "crc32(cast(doc_id AS string)) % 5 <> 0") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from its whole text alone.

    Two dictionaries share a trained part of ordinary text; one adds what toxic texts repeat, the other the ordinary words most
    like it. A window's gain is the difference of its compressed lengths; calibrated thresholds on the gains of all
    windows of a text give its score. A null or empty text scores as one without any gain; a null doc_id is
    never learnt from and counts as held out. Without labels of both kinds all scores are 0. Repeated rows score alike.
    """
    model = fitted(docs, labels, may_learn)
    held = ~F.coalesce(F.expr(may_learn), F.lit(False))
    rows = only(docs, ["doc_id", "text"]).select("doc_id", held.alias("held_out"), "text")
    scored = rows.mapInPandas(_scored(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
