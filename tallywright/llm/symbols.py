"""Encoding and decoding with merge-type SentencePiece vocabularies, by an agenda of adjacent symbol pairs.

A text's symbols are its characters. The agenda holds each adjacent pair whose joint piece is in the vocabulary, the best
score first and then the leftmost; the pair taken becomes one symbol and its neighbours are looked at again.
In each Arrow batch the library encodes the runs of characters that are new to the worker and decodes every row's ids, and
each row says whether it agrees.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import CHARS_AT_ONCE, only

MODEL = "piece_bpe_32k.model"
#: A worker keeps the words of its last one or two times so many misses; longer words are not kept.
MEMO, MEMO_WORD = 500_000, 64
#: Up to so many symbols the agenda is a plain list, beyond a heap.
SHORT = 24
SPACE = "▁"
#: Letters, runs of them with the spaces before, and runs of other characters with the spaces before.
_LETTER = r"[^\W\d_¹²³]"
_RUNS = re.compile(f"{SPACE}*(?:{_LETTER}+|(?:(?!{_LETTER})[^{SPACE}])+|$)")
_MIXED = re.compile(f"{_LETTER}(?!{_LETTER}).|[^{SPACE}](?<!{_LETTER}){_LETTER}", re.DOTALL)


class Vocabulary:
    """Pieces, scores and byte pieces of one model file, and the merge rule over them."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        path = path or public_tokenizers.path(MODEL)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind, rule = model.pieces[0].__class__, model.normalizer_spec
        known = {kind.NORMAL, kind.BYTE, kind.CONTROL, kind.UNKNOWN}
        plain = rule.name == "identity" and not rule.remove_extra_whitespaces and rule.escape_whitespaces and not rule.precompiled_charsmap
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not plain or not all(p.type in known for p in model.pieces):
            raise ValueError("a merge-type vocabulary of plain pieces, without rewriting of characters, is needed")
        self.dummy = SPACE if rule.add_dummy_prefix else ""
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model.normalizer_spec.add_dummy_prefix = False
        self.library_of_runs = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        levels = {x: i for i, x in enumerate(sorted({-p.score for p in model.pieces}))}
        self.cost = {p.piece: levels[-p.score] for p in model.pieces if p.type == kind.NORMAL}
        self.none = len(levels)
        self.byte = [-1] * 256
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
        if not model.trainer_spec.byte_fallback or -1 in self.byte:
            raise ValueError("characters outside the vocabulary need byte pieces")
        of_byte = {i: bytes([b]) for b, i in enumerate(self.byte)}
        said = {kind.NORMAL: lambda p: p.piece.replace(SPACE, " "), kind.UNKNOWN: lambda p: model.trainer_spec.unk_surface}
        self.surface = [of_byte.get(i) or said.get(p.type, lambda p: "")(p).encode() for i, p in enumerate(model.pieces)]
        self.leading = {i for p, i in self.id.items() if p.startswith(SPACE)}
        #: No piece has a space after another character, so no merge crosses the start of a word; the same
        #: holds between letters and other characters, if no piece mixes them.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.by_run = self.by_word and not any(_MIXED.search(p) for p in self.id)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Runs encoded since the library last looked, and those on which it does not agree.
        self.fresh: dict[str, bytes] = {}
        self.wrong: set[str] = set()

    def merged(self, word: str) -> list[str]:
        """Symbols left when no adjacent pair is a piece any more: the best pair is joined first, of equals the leftmost."""
        symbol = list(word)
        return self._short(symbol) if len(symbol) <= SHORT else self._long(symbol)

    def _short(self, symbol: list[str]) -> list[str]:
        cost, none = self.cost, self.none
        agenda = [cost.get(p, none) for p in map(str.__add__, symbol, symbol[1:])]
        while agenda and (best := min(agenda)) < none:
            a = agenda.index(best)
            symbol[a] = pair = symbol[a] + symbol.pop(a + 1)
            del agenda[a]
            if a < len(agenda):
                agenda[a] = cost.get(pair + symbol[a + 1], none)
            if a:
                agenda[a - 1] = cost.get(symbol[a - 1] + pair, none)
        return symbol

    def _long(self, symbol: list[str]) -> list[str]:
        cost, none, n = self.cost, self.none, len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        at = [cost.get(p, none) for p in map(str.__add__, symbol, symbol[1:])] + [none]  # of the pair that starts there now
        agenda = [(c, i) for i, c in enumerate(at) if c < none]
        heapq.heapify(agenda)
        while agenda:
            c, a = heapq.heappop(agenda)
            if at[a] != c:
                continue  # one of the two has been joined to another since
            b = after[a]
            symbol[a] = pair = symbol[a] + symbol[b]
            symbol[b], at[a], at[b] = "", none, none
            after[a] = e = after[b]
            if e >= 0:
                before[e] = a
                at[a] = c = cost.get(pair + symbol[e], none)
                if c < none:
                    heapq.heappush(agenda, (c, a))
            if (z := before[a]) >= 0:
                at[z] = c = cost.get(symbol[z] + pair, none)
                if c < none:
                    heapq.heappush(agenda, (c, z))
        return [x for x in symbol if x]

    def word_ids(self, word: str) -> bytes:
        """Packed 32-bit ids of a word; a symbol outside the vocabulary becomes its bytes."""
        if (got := self.memo.get(word)) is not None:
            return got
        if (got := self.older.get(word)) is None:
            self.fresh[word] = got = self._ids(self.merged(word))
        if len(word) <= MEMO_WORD:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[word] = got
        return got

    def _ids(self, symbols: list[str]) -> bytes:
        ids = array("i")
        for s in symbols:
            if (i := self.id.get(s)) is not None:
                ids.append(i)
            else:
                ids.extend([self.byte[b] for b in s.encode("utf-8", "surrogatepass")])
        return ids.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Packed 32-bit ids of a whole text; a null or empty text has none."""
        if not text:
            return b""
        get, of = self.memo.get, self.word_ids
        return b"".join([get(p) or of(p) for p in self.runs(text)])

    def runs(self, text: str) -> list[str]:
        """Parts of a text that no merge joins; a run of spaces belongs to what comes after it."""
        marked = self.dummy + text.replace(" ", SPACE)
        if self.by_run:
            return _RUNS.findall(marked)
        return re.findall(f"{SPACE}*(?:[^{SPACE}]+|$)", marked) if self.by_word else [marked]

    def check(self, texts: list[str]) -> list[bool]:
        """Whether the library agrees on all runs of each text; each run is held against it once after it is encoded."""
        runs = list(self.fresh)
        theirs = self.library_of_runs.encode(runs, num_threads=1)
        self.wrong |= {r for r, t in zip(runs, theirs, strict=True) if array("i", t).tobytes() != self.fresh[r]}
        self.fresh.clear()
        return [self.wrong.isdisjoint(self.runs(t)) if self.wrong and t else True for t in texts]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, byte pieces read as UTF-8, the space of the first piece left out.

        A byte that belongs to no character becomes U+FFFD on its own; control pieces have no text.
        """
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        if self.dummy and next((i for i in ids if surface[i]), None) in self.leading:
            data = data[1:]
        return _utf8(data)


def _utf8(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out += [data[: e.start].decode(), "\ufffd"]
            data = data[e.start + 1 :]
    return "".join(out)


_LOADED: dict[str | None, Vocabulary] = {}


def vocabulary(path: str | None = None) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``CHARS_AT_ONCE`` bytes of text and one more text at most."""
    size = np.asarray(pc.binary_length(batch.column("text")).fill_null(0))
    part = np.cumsum(size) // CHARS_AT_ONCE
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, e in zip(cut, cut[1:]):
        if e > a:
            yield batch.slice(a, e - a)


def _encoded(path: str | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for whole in batches:
            for batch in _slices(whole):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                packed = [own.encode(t) for t in texts]
                ids = [np.frombuffer(p, np.int32).tolist() for p in packed]
                decoded = [own.decode(i) for i in ids]
                agrees = [a and x == y for a, x, y in zip(own.check(texts), decoded, own.library.decode(ids, num_threads=1), strict=True)]
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(packed), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["doc_id", "ids", "decoded", "agrees"]
                )

    return rows


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded, agrees`` of every row of ``docs(doc_id, text)``: its ids, their text, and whether the library gives both.

    Neither begin nor end ids; special strings in a text are ordinary text. A null or empty text has no ids and an empty decoded text.
    Spaces and the vocabulary's own space sign are one thing to it, so a text with that sign decodes to a space. Each
    row stands for itself: null and repeated doc_ids and repeated texts are kept, an empty table gives no rows. Words are
    encoded once a worker while its memo lasts; a text is never cut. Other columns are ignored.
    """
    return only(docs, ["doc_id", "text"]).mapInArrow(_encoded(path), "doc_id long, ids array<int>, decoded string, agrees boolean")
