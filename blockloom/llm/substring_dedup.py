"""Substring dedup by level-wise doubling: words covered by a window that occurs anywhere else are removed.

Levels for a window of 35 words: grams of 8, 16, 32 and 35 words.  Only what repeats at one length is extended to
twice that length; the last step goes to the full window.  The first level takes one gram in about fourteen words
(``anchors``), which is enough since equal windows choose equal grams.  Contexts that repeat as a whole need no
further levels; the others go through them here.

Defined cases: null text has no words; fewer words than the window keep all; repeated rows repeat each other's
windows, so all their covered words go; ids are not compared, so rows that share an id or have none are documents like
any other; an empty table gives an empty result; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from . import kernel as K
from .anchors import FULL, NEED, SEND, Method, repeated

WINDOW = 35
GRAM = 8
#: Bytes of a word's hash in a context.
SYMBOL = 5


def classify(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows in order of key, context: all keys here occur twice or more."""
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_ctx = new_key | np.concatenate([[True], ctx[1:] != ctx[:-1]])
    c, k = np.cumsum(new_ctx) - 1, np.cumsum(new_key) - 1
    size = np.bincount(c)[c]
    lone = np.bincount(k, size == 1)[k] > 0
    return np.where(size > 1, FULL, NEED | SEND) | np.where(new_ctx & lone, SEND, 0)


def compare(gram: np.ndarray, rank: np.ndarray, wide: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Windows that occur twice; column ``d`` is the window that starts ``d`` words before the gram."""
    reach = WINDOW - GRAM
    n = len(gram)
    up, _ = K.powers(WINDOW)
    salt = K.mix(gram)

    def word(rows: np.ndarray, at: int) -> np.ndarray:
        out = np.zeros((len(rows), 8), np.uint8)
        out[:, :SYMBOL] = wide[rows, at * SYMBOL : (at + 1) * SYMBOL]
        return K.mix(out.view("<u8").reshape(-1).astype(K.U64))

    every = np.arange(n)
    alive, length = K.duplicated(gram)[:, None], GRAM
    while True:
        longer = min(2 * length, WINDOW)
        more = np.zeros((n, longer - GRAM + 1), bool)
        # the hash of a window rolls one word to the left at a time
        h = np.zeros(n, K.U64)
        for k in range(longer):
            h += word(every, reach + k) * up[k]
        for d in range(longer - GRAM + 1):
            if d:
                h = (h - word(every, reach - d + longer) * up[longer - 1]) * up[1] + word(every, reach - d)
            # the shorter windows through the gram that lie inside this one
            inside = alive[:, max(0, d - (longer - length)) : min(d, length - GRAM) + 1]
            rows = np.flatnonzero(inside.all(axis=1) & (left >= d) & (right >= longer - d))
            if len(rows):
                more[rows[K.duplicated(K.mix(h[rows] ^ salt[rows]))], d] = True
        if longer == WINDOW or not more.any():
            return more if longer == WINDOW else np.zeros((n, reach + 1), bool)
        alive, length = more, longer


def tokens(data: np.ndarray, offs: np.ndarray):
    w = K.Words(data, offs)
    return w.hashes(data), w.first, w


def _result(data, offs, w, first, covered):
    removed = K.counts(covered, first)
    raw, digests = data.tobytes(), []
    for i in range(len(offs) - 1):
        words = raw[offs[i] : offs[i + 1]].split()
        if removed[i]:
            words = [x for x, gone in zip(words, covered[first[i] : first[i + 1]].tolist()) if not gone]
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return {"n_words": np.diff(first), "n_removed": removed, "kept_sha256": digests}


def _kept_text(data, offs, w, first, covered):
    raw, kept = data.tobytes(), []
    for i in range(len(offs) - 1):
        words = raw[offs[i] : offs[i + 1]].split()
        kept.append(b" ".join(x for x, gone in zip(words, covered[first[i] : first[i + 1]].tolist()) if not gone).decode())
    return {"n_removed": K.counts(covered, first), "kept": kept}


DIGEST = Method("op7", WINDOW, GRAM, tokens, classify, compare, _result, "n_words long,n_removed long,kept_sha256 string", SYMBOL, 0)
TEXT = Method("op7-text", WINDOW, GRAM, tokens, classify, compare, _kept_text, "n_removed long,kept string", SYMBOL, 0)


def substring_dedup(docs: DataFrame, *, text: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` with counts and the digest of the words left, or with ``text`` the words themselves; ``carry`` names columns to
    hand through (as strings)."""
    return repeated(docs, TEXT if text else DIGEST, id_col, text_col, carry)
