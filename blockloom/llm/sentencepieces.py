"""Encoding to and decoding from the ids of a SentencePiece model, by words that share prefixes.

No piece contains a word mark after another character, so a text can be cut before each run of marks and its
words encoded alone.  The distinct marked words of a slice are sorted, which lays them out as the depth-first
order of a trie; the forward table of the word before is kept up to the common prefix and only the rest of a
word is computed.

The forward table of a unigram model is Viterbi's: the best score of each prefix and its last piece.  A BPE model is
not a best-score path: its encoding is the outcome of merges in order of score.  Its forward table holds the last
piece of the encoding of each prefix; it is the one piece that ends the prefix and, next to the last piece of what
stands before it, survives the merges of the two.  Both tables depend on the prefix alone and are shared alike.

Models with another normalisation than identity (with a dummy prefix and escaped spaces) are refused.

Defined cases: a null or empty text has no ids and decodes to the empty text; characters without a piece become byte
pieces, or one unknown id if the model has none; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import small_batches

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Words kept with their ids in a worker, and pairs of pieces with their verdict.
KEPT_WORDS = 400_000
KEPT_PAIRS = 2_000_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _fields(data: bytes):
    """``(field number, value)`` of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces of a model file and the two directions."""

    def __init__(self, data: bytes):
        top = list(_fields(data))
        trainer, norm = (dict(_fields(next((v for k, v in top if k == n), b""))) for n in (2, 3))
        self.kind = trainer.get(3, UNIGRAM)
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models with identity normalisation are supported")
        self.prefix = bool(norm.get(3, 1))
        self.pieces, self.scores, kinds = [], [], []
        for k, v in top:
            if k == 1:
                f = dict(_fields(v))
                self.pieces.append(f.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(f.get(3, 1))
        # kinds of pieces: 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
        if self.kind not in (UNIGRAM, BPE) or 4 in kinds:
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == 1}
        if any(MARK in p.lstrip(MARK) or p.startswith(MARK * 2) and p.strip(MARK) for p in self.ids):
            raise ValueError("pieces that cross words are not supported")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == 6}
        self.unknown = kinds.index(2) if 2 in kinds else 0
        self.longest = max(map(len, self.ids), default=1)
        self.raw = [bytes([int(p[3:5], 16)]) if k == 6 else " ⁇ ".encode() if k == 2 else b"" if k == 3 else p.encode() for p, k in zip(self.pieces, kinds)]
        self.low = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        #: Endings of pieces: true for a whole piece.
        self.ends = {p[i:]: False for p in self.ids for i in range(1, len(p))} | dict.fromkeys(self.ids, True)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merges: the best-scored neighbours first, the left of equals."""
        parts = list(text)
        while True:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                n = self.ids.get(parts[i] + parts[i + 1])
                if n is not None and self.scores[n] > best:
                    best, at = self.scores[n], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, a: str, b: str) -> bool:
        """Whether the merges of ``a + b`` end in these two pieces; ``a`` may be empty."""
        return self.merged(a + b) == ([a, b] if a else [b])

    def _bpe(self, words: list[str]):
        ends, pairs = self.ends, self.pairs
        before, last = "", [""]
        for w in words:
            keep, most = 0, min(len(w), len(before))
            while keep < most and w[keep] == before[keep]:
                keep += 1
            del last[keep + 1 :]
            for i in range(keep + 1, len(w) + 1):
                at = i
                while at:
                    at -= 1
                    piece = w[at:i]
                    whole = ends.get(piece)
                    if whole is None:  # no piece ends like this: the character has none
                        last.append(w[i - 1])
                        break
                    if whole:
                        verdicts = pairs.get(last[at])
                        if verdicts is None:
                            verdicts = pairs[last[at]] = {}
                        fits = verdicts.get(piece)
                        if fits is None:
                            self.n_pairs += 1
                            fits = verdicts[piece] = self.stays(last[at] if last[at] in self.ids else "", piece)
                        if fits:
                            last.append(piece)
                            break
                else:
                    last.append(w[i - 1])
            before = w
            out, i = [], len(w)
            while i:
                out.append(last[i])
                i -= len(last[i])
            out.reverse()
            yield out

    def _unigram(self, words: list[str]):
        before, table = "", [(0.0, "")]
        for w in words:
            keep = len(os.path.commonprefix((before, w)))
            del table[keep + 1 :]
            for i in range(keep + 1, len(w) + 1):
                found = [(table[i - n][0] + self.scores[self.ids[w[i - n : i]]], w[i - n : i]) for n in range(min(i, self.longest), 0, -1) if w[i - n : i] in self.ids]
                if w[i - 1] not in self.ids:
                    found.append((table[i - 1][0] + self.low, w[i - 1]))
                table.append(max(found, key=lambda x: x[0]))
            before = w
            out, i = [], len(w)
            while i:
                out.append(table[i][1])
                i -= len(table[i][1])
            yield out[::-1]

    def _numbers(self, parts: list[str]) -> list[int]:
        out = []
        for p in parts:
            n = self.ids.get(p)
            if n is not None:
                out.append(n)
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return _WORD.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def learn(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of all ``words``; those not kept from before are computed in sorted order."""
        kept = self.words
        new = sorted(words.difference(kept))
        if self.n_pairs > KEPT_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = sorted(words)
        for w, parts in zip(new, (self._bpe if self.kind == BPE else self._unigram)(new)):
            kept[w] = self._numbers(parts)
        return kept

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.split(t) for t in texts]
        table = self.learn(set(chain.from_iterable(cut)))
        return [list(chain.from_iterable(map(table.__getitem__, c))) for c in cut]

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def _model(data: bytes) -> Model:
    return Model(data)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_words, ids, round_trip``: the last tells whether the ids decode to the text."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    def run(batches):
        m = _model(model)
        for rb in batches:
            texts = [t or "" for t in rb.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= K.SLICE_BYTES):
                    size += len(texts[end])
                    end += 1
                cut = [m.split(t) for t in texts[at:end]]
                table = m.learn(set(chain.from_iterable(cut)))
                ids = [list(chain.from_iterable(map(table.__getitem__, c))) for c in cut]
                n = np.array([len(x) for x in ids], np.int64)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(n.sum()))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
                trips = [m.decode(x) == t for x, t in zip(ids, texts[at:end])]
                cols = [rb.column(0).slice(at, end - at), pa.array(n), pa.array([len(c) for c in cut], pa.int64()), lists, pa.array(trips)]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
                at = end

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long,n_tokens long,n_words long,ids array<int>,round_trip boolean")


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ids; null ids give an empty text."""
    small_batches(encoded.sparkSession)

    def run(batches):
        m = _model(model)
        for rb in batches:
            yield K.table(K.arrow_schema("doc_id long,text string"), doc_id=rb.column(0), text=[m.decode(x or []) for x in rb.column(1).to_pylist()])

    return encoded.select(F.col("doc_id").cast("long"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long,text string")


def model_digest(model: bytes) -> str:
    return hashlib.sha256(model).hexdigest()
