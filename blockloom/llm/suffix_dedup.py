"""Suffix-array dedup: bytes covered by a string that an earlier document holds are removed.

A string of ``WINDOW`` bytes is removed from every document but the one with the smallest id that holds it.  The
longest earlier match of a suffix is found in suffix order from the nearest suffixes before and after it that
belong to an earlier document (previous and next smaller), as for a longest-previous-factor array.

The corpus gets a sparse suffix array: ``anchors`` brings together suffixes whose windows share an anchor, and
here each such group is put in suffix order, once for each distance between a window's start and the anchor.  The
order for distance ``d`` is induced from that for ``d - 1`` by one stable pass over the byte in front.

A context that repeats as a whole in an earlier document is settled by its hash; suffix order decides all others.

Defined cases: null text is empty, nothing is removed; texts shorter than the window keep all; equal ids never
remove from each other, whatever their texts (repeated rows keep their text); null ids count as the largest and as equal;
an empty table gives an empty result; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from . import kernel as K
from .anchors import FULL, NEED, SEND, Method, repeated

WINDOW = 50
#: Long enough that equal grams are mostly repeated passages, short enough for one anchor in 16 bytes.
GRAM = 20


def suffix_array(s: bytes) -> np.ndarray:
    """Suffix array by prefix doubling, in memory."""
    n = len(s)
    rank = np.frombuffer(s, np.uint8).astype(np.int64)
    sa, k = np.argsort(rank, kind="stable"), 1
    while n and k < 2 * n:
        second = np.full(n, -1, np.int64)
        second[: max(0, n - k)] = rank[k:]
        sa = np.lexsort((second, rank))
        new = np.zeros(n, np.int64)
        new[1:] = (rank[sa][1:] != rank[sa][:-1]) | (second[sa][1:] != second[sa][:-1])
        rank[sa] = np.cumsum(new)
        if rank[sa[-1]] == n - 1:
            break
        k *= 2
    return sa


def lcp_array(s: bytes, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in suffix order."""
    n = len(s)
    rank = np.empty(n, np.int64)
    rank[sa] = np.arange(n)
    lcp, h = np.zeros(n, np.int64), 0
    for i in range(n):
        if rank[i]:
            j = sa[rank[i] - 1]
            while i + h < n and j + h < n and s[i + h] == s[j + h]:
                h += 1
            lcp[rank[i]] = h
            h = max(0, h - 1)
        else:
            h = 0
    return lcp


def longest_earlier(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place in suffix order, the longest common prefix with a suffix of smaller ``value`` (the previous
    and the next smaller place give the longest on either side); with positions as values, the LPF array."""
    n = len(value)
    best = np.zeros(n, np.int64)
    for order, gap in ((range(n), lambda i: lcp[i]), (range(n - 1, -1, -1), lambda i: lcp[i + 1] if i + 1 < n else 0)):
        stack: list[tuple[int, int]] = []  # values that rise, with the common prefix to the entry above
        for i in order:
            reach = int(gap(i))
            while stack and stack[-1][0] >= value[i]:
                reach = min(reach, stack.pop()[1])
            if stack:
                best[i] = max(best[i], reach)
            stack.append((int(value[i]), reach))
    return best


def classify(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows in order of key, context, document."""
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_ctx = new_key | np.concatenate([[True], ctx[1:] != ctx[:-1]])
    k, c = np.cumsum(new_key) - 1, np.cumsum(new_ctx) - 1
    k_at, c_at = np.flatnonzero(new_key), np.flatnonzero(new_ctx)
    key_min, key_max = np.minimum.reduceat(doc, k_at)[k], np.maximum.reduceat(doc, k_at)[k]
    ctx_min = doc[c_at][c]
    many = np.bincount(k[c_at])[k] > 1
    state = np.where(doc > ctx_min, FULL, 0)
    first = (doc == ctx_min) & many & (key_min != key_max)
    return state | np.where(first, SEND, 0) | np.where(first & (ctx_min > key_min), NEED, 0)


def earlier(rank: np.ndarray, lcp: np.ndarray, length: int) -> np.ndarray:
    """For each place in suffix order, whether its longest previous factor has ``length``: whether a suffix of smaller
    rank stands before it or after it (the previous and the next smaller place) with no common prefix below ``length``
    in between.  ``lcp`` is capped at ``length``, so within a stretch all matches are equally long."""
    n = len(rank)
    if not n:
        return np.zeros(0, bool)
    stretch = np.cumsum(np.concatenate([[0], lcp[1:] < length]))
    # running minima of each stretch: ranks as codes, falling by a full range from one stretch to the next
    code = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    high = int(code.max()) + 1
    before = np.minimum.accumulate(code - stretch * high) + stretch * high
    back = stretch[-1] - stretch
    after = (np.minimum.accumulate((code - back * high)[::-1]))[::-1] + back * high
    return (before < code) | (after < code)


def compare(gram: np.ndarray, rank: np.ndarray, wide: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Windows that an earlier document holds; column ``d`` is the window that starts ``d`` bytes before the anchor.

    The suffixes that start ``d`` bytes before the anchors are put in suffix order, neighbours' common prefixes are taken
    byte by byte, and ``earlier`` tells where the longest previous factor fills the window."""
    reach = WINDOW - GRAM
    n = len(gram)
    hit = np.zeros((n, reach + 1), bool)
    code = np.unique(gram, return_inverse=True)[1].astype(np.uint16 if n < 65_536 else np.int64)
    padded = np.zeros((n, 56), np.uint8)
    padded[:, :WINDOW] = wide[:, reach:]
    words = padded.view(">u8")
    order = np.lexsort((*(words[:, i] for i in range(6, -1, -1)), code))
    for d in range(reach + 1):
        if d:
            order = order[np.argsort(wide[order, reach - d], kind="stable")]
            order = order[np.argsort(code[order], kind="stable")]
        at = order[(left[order] >= d) & (right[order] >= WINDOW - d)]
        if len(at) < 2:
            continue
        text = wide[at, reach - d : reach - d + WINDOW]
        differ = text[1:] != text[:-1]
        lcp = np.zeros(len(at), np.int64)
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW)
        lcp[1:][code[at][1:] != code[at][:-1]] = 0
        hit[at, d] = earlier(rank[at], lcp, WINDOW)
    return hit


def tokens(data: np.ndarray, offs: np.ndarray):
    return K.BYTE_HASH[data], offs, None


def _result(data, offs, more, first, covered):
    starts, _ = K.runs(covered, first)
    spans = np.bincount(np.searchsorted(first, starts, "right") - 1, minlength=len(offs) - 1)
    removed = K.counts(covered, first)
    digests = []
    for i in range(len(offs) - 1):
        d = data[offs[i] : offs[i + 1]]
        digests.append(hashlib.sha256((d[~covered[offs[i] : offs[i + 1]]] if removed[i] else d).tobytes()).hexdigest())
    return {"n_bytes": np.diff(offs), "n_removed": removed, "n_spans": spans.astype(np.int64), "kept_sha256": digests}


def _kept_text(data, offs, more, first, covered):
    """What is left as text; bytes of a character that was cut go too."""
    kept = [data[a:b][~covered[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(offs[:-1], offs[1:])]
    return {"n_removed": K.counts(covered, first), "kept": kept}


DIGEST = Method("op6", WINDOW, GRAM, tokens, classify, compare, _result, "n_bytes long,n_removed long,n_spans long,kept_sha256 string", 1, 8)
TEXT = Method("op6-text", WINDOW, GRAM, tokens, classify, compare, _kept_text, "n_removed long,kept string", 1, 8)


def suffix_dedup(docs: DataFrame, *, text: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` with counts and the digest of what is left, or with ``text`` what is left itself; ``carry`` names columns to
    hand through (as strings)."""
    return repeated(docs, TEXT if text else DIGEST, id_col, text_col, carry)
