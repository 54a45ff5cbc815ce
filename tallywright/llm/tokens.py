"""Token counts from pre-token frequencies, and the pre-token splitting that counting and packing share."""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, raw

TOKENIZER = "word_bpe_49k.json"
#: A worker forgets what it has split beyond this many chunks or pre-tokens (some 150 MB).
MEMO = 700_000
#: Commonest pre-tokens sent to every task (a few MB at most), and the documents sampled to find them. They only
#: decide which pre-tokens are counted without a shuffle; no result depends on them.
HEAD, HEAD_SAMPLE = 150_000, 20_000

_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ASCII_SPACE = re.compile("[ \t\n\r]+")
_SIMPLE = re.compile("[!-~\xa1-\xac\xae-\xff]+")
#: The tokenizer's own split pattern, written out for lower-case Latin-1.
_LETTER, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PRE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_BYTE = _byte_letters()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Pieces:
    """One tokenizer of a worker, with memos of what it has split.

    A text's tokens are those of its chunks between ASCII spaces in a row: no pre-token, normalised form or special
    string of this tokenizer spans a space. Chunks of printable Latin-1 are split by the tokenizer's pattern
    here; any other chunk, or one that may hold a special string, goes to the tokenizer whole.
    """

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.seen: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        if _SPACE.search(text):
            return [c for c in _ASCII_SPACE.split(text) if c]
        return text.split()

    def pre_tokens(self, chunk: str) -> list[str] | None:
        """Byte-level pre-tokens of a chunk; None if it holds a special string."""
        if _SIMPLE.fullmatch(chunk) and "<|" not in chunk:
            return [p if p.isascii() else "".join([_BYTE[b] for b in p.encode()]) for p in _PRE.findall(chunk.lower())]
        if any(s in chunk for s in self.special):
            return None
        return [p for p, _ in self.own.pre_tokenizer.pre_tokenize_str(self.own.normalizer.normalize_str(chunk))]

    def count(self, pre: str) -> int:
        return len(self.own.model.tokenize(pre))

    def whole(self, chunk: str) -> list[int]:
        return self.own.encode(chunk, add_special_tokens=False).ids

    def ids_of(self, chunk: str) -> bytes:
        """Little-endian 32-bit ids of a chunk."""
        pre = self.pre_tokens(chunk)
        if pre is None:
            return _packed(self.whole(chunk))
        out = []
        for p in pre:
            if (got := self.pieces.get(p)) is None:
                if len(self.pieces) >= MEMO:
                    self.pieces.clear()
                got = self.pieces[p] = _packed([t.id for t in self.own.model.tokenize(p)])
            out.append(got)
        return b"".join(out)

    def ids(self, text: object) -> bytes:
        """Ids of a whole text."""
        seen, out = self.seen, []
        if len(seen) >= MEMO:
            seen.clear()
        for c in self.chunks(text) if isinstance(text, str) else ():
            if (got := seen.get(c)) is None:
                got = seen[c] = self.ids_of(c)
            out.append(got)
        return b"".join(out)


_LOADED: dict[str | None, Pieces] = {}


def pieces(path: str | None) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _head(path: str | None):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pieces(path)
        for f in frames:
            seen: Counter[str] = Counter()
            for t in f["text"]:
                for c, n in Counter(own.chunks(t)).items() if isinstance(t, str) else ():
                    for p in own.pre_tokens(c) or ():
                        seen[p] += n
            yield pd.DataFrame({"pre": list(seen.keys()), "times": list(seen.values())})

    return rows


def _frequencies(path: str | None, head: dict[str, int]):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own, at = pieces(path), TaskContext.get().partitionId() << 40
        memo: dict[str, tuple[int, list[str]]] = {}
        for f in frames:
            doc, row, pre, times, size = [], [], [], [], []
            for d, t in zip(f["doc_id"], f["text"], strict=True):
                known, rare = 0, Counter()
                for c, n in Counter(own.chunks(t)).items() if isinstance(t, str) else ():
                    if (got := memo.get(c)) is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        parts = own.pre_tokens(c)
                        if parts is None:
                            got = (len(own.whole(c)), [])
                        else:
                            got = (sum(head.get(p, 0) for p in parts), [p for p in parts if p not in head])
                        memo[c] = got
                    known += n * got[0]
                    for p in got[1]:
                        rare[p] += n
                pre += [None, *rare]
                times += [known, *rare.values()]
                row += [at] * (1 + len(rare))
                doc += [d] + [None] * len(rare)
                size += [len(raw(t))] + [None] * len(rare)
                at += 1
            yield pd.DataFrame(
                {"row": row, "doc_id": pd.array(doc, "Int64"), "n_bytes": pd.array(size, "Int64"), "pre": pre, "times": times}
            )

    return rows


def _counted(path: str | None):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, last = pieces(path), (None, 1)
        for f in frames:
            code, kinds = pd.factorize(f["pre"])  # sorted input: each kind is in one run
            many = [last[1] if p == last[0] else own.count(p) for p in kinds]
            if many:
                last = (kinds[-1], many[-1])
            each = np.array([*many, 1])[code]  # code -1: the row that carries the document
            yield f[["row", "doc_id", "n_bytes"]].assign(n=f["times"].to_numpy() * each)

    return rows


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, as the tokenizer counts, without making its ids.

    Per-document pre-token frequencies meet the pieces of each pre-token: commonest pre-tokens in a table of
    bounded size that every task has, all others by a shuffle that brings a pre-token's frequencies to
    the one place where its pieces are counted, once. Sums per row follow. A null text has no tokens; special strings in
    a text count as the tokenizer takes them. Repeated rows and null doc_ids are rows of their own.
    """
    source = only(docs, ["doc_id", "text"])
    step = max(1, source.count() // HEAD_SAMPLE)
    sample = source.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text")
    common = sample.mapInPandas(_head(path), "pre string, times long").groupBy("pre").agg(F.sum("times").alias("times"))
    best = common.where(F.length("pre") <= 64).orderBy(F.desc("times"), "pre").limit(HEAD).select("pre")
    own = pieces(path)
    head = {r.pre: own.count(r.pre) for r in best.collect()}
    rows = source.mapInPandas(_frequencies(path, head), "row long, doc_id long, n_bytes long, pre string, times long")
    met = rows.repartition(F.coalesce("pre", F.col("row").cast("string"))).sortWithinPartitions("pre")
    sums = met.mapInPandas(_counted(path), "row long, doc_id long, n_bytes long, n long").groupBy("row")
    total = sums.agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
