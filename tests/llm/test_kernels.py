"""Kernels without Spark: words, suffix arrays, doubling, curves, packing, bounds, tokenizer models."""

import collections
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockloom.llm import hilbert_search, kernel as K, lm_scores, minhash, packing, quality, sentencepieces, substring_dedup, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slice_of(texts):
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode(), np.uint8), offs


@given(st.lists(st.text(alphabet=" \t\nabé .", max_size=12), min_size=1, max_size=6))
@settings(deadline=None)
def test_words_match_the_pattern(texts):
    data, offs = slice_of(texts)
    w = K.Words(data, offs)
    got = [[] for _ in texts]
    for s, e, d in zip(w.start, w.end, w.doc):
        got[d].append(data[s:e].tobytes().decode())
    assert got == [WORD.findall(t) for t in texts]
    hashes = w.hashes(data)
    flat = [x for g in got for x in g]
    assert len(set(hashes.tolist())) == len(set(flat))


def test_slices_of_nulls_and_long_rows():
    rb = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([None, "x" * 100, "", "y"])], names=["id", "text"])
    parts = [(r.column(0).to_pylist(), o.tolist()) for r, _, o in K.slices([rb.slice(0, 4)], "text", 10)]
    assert [i for p, _ in parts for i in p] == [1, 2, 3, 4]


@given(st.text(alphabet="ab", max_size=40))
@settings(deadline=None)
def test_longest_previous_factor(s):
    b = s.encode()
    sa = suffix_dedup.suffix_array(b)
    assert [b[i:] for i in sa] == sorted(b[i:] for i in range(len(b)))
    if not b:
        return
    got = np.zeros(len(b), np.int64)
    got[sa] = suffix_dedup.longest_earlier(sa, suffix_dedup.lcp_array(b, sa))
    for i in range(len(b)):
        want = max((len(os.path.commonprefix([b[i:], b[j:]])) for j in range(i)), default=0)
        assert got[i] == want


def test_doubling_finds_windows_that_occur_twice():
    rng = np.random.default_rng(0)
    n, reach = 200, substring_dedup.WINDOW - substring_dedup.GRAM
    wide = rng.integers(0, 256, (n, reach + substring_dedup.WINDOW, substring_dedup.SYMBOL)).astype(np.uint8)
    wide[:, reach : reach + 8] = wide[0, reach : reach + 8]
    for i in range(1, n, 2):  # a shared stretch of random width around the gram
        a, b = rng.integers(0, reach + 1), rng.integers(reach + 8, wide.shape[1] + 1)
        wide[i, a:b] = wide[0, a:b]
    key, side = np.zeros(n, K.U64), np.full(n, 100)
    got = substring_dedup.compare(key, np.arange(n), wide.reshape(n, -1), side, side)
    for d in range(reach + 1):
        rows = [wide[i, reach - d : reach - d + substring_dedup.WINDOW].tobytes() for i in range(n)]
        assert got[:, d].tolist() == [rows.count(r) > 1 for r in rows]


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=40))
@settings(deadline=None)
def test_earlier_is_the_longest_previous_factor_that_fills_a_window(rows):
    rank, lcp = np.array([r for r, _ in rows], np.int64), np.array([min(x, 6) for _, x in rows], np.int64)
    assert suffix_dedup.earlier(rank, lcp, 6).tolist() == (suffix_dedup.longest_earlier(rank, lcp) >= 6).tolist()


def test_hilbert_keys_are_a_walk():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert_search.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(deadline=None)
def test_packing_holds_everything(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offset, caps = packing.pack(lengths, (16, 32, 64), 2)
    used = {}
    for n, b, o in sorted(zip(lengths, where, offset), key=lambda x: (x[1], x[2])):
        assert used.get(b, 0) == o
        used[b] = o + n
    for b, c in enumerate(caps):
        assert used[b] <= c and c == min(x for x in (16, 32, 64) if x >= used[b])


def test_exact_bound():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05**0.01, abs=1e-9)
    for k, n in ((1, 30), (5, 200)):
        p = quality.upper_bound(k, n, 0.01)
        assert sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) == pytest.approx(0.01, rel=1e-6)
    assert quality.most_rejected(10, 0.01, 0.05) == -1 and quality.most_rejected(100_000, 0.01, 0.001) > 800


def test_clause_events():
    i, t, n, r, o = toxicity.C_INSULT, toxicity.C_TARGET, toxicity.C_NEG, toxicity.C_REP, toxicity.OTHER
    name = lambda tape: [toxicity.EVENTS[e] for e in toxicity.clause_events(tape)]
    assert name([o, i, o]) == ["insult"] and name([t, i]) == ["insult_target"] and name([i, o, t]) == ["insult_target"]
    assert name([n, o, i]) == ["insult_negated"] and name([r, n, i]) == ["insult_reported"] and name([n, o, o, o, o, o, i]) == ["insult"]
    assert name([toxicity.C_THREAT, t]) == ["threat_target"] and name([toxicity.C_STEM]) == ["stem"] and name([]) == []


def test_lexicon_prefers_words_of_many_contexts():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(3, 7)))
    good = [" ".join(word() for _ in range(40)) for _ in range(200)]
    bad = [" ".join([*(word() for _ in range(20)), "scumbag", *(word() for _ in range(20))]) for _ in range(30)]
    copy = " ".join(word() for _ in range(40)) + " copiedword scumbag x"
    texts = [t.encode() for t in good + bad + [copy] * 30]
    g = toxicity.fit(texts, np.array([0] * 200 + [1] * 60))
    s = lambda t: float(g.score(g.events(*slice_of([t])))[0])
    assert s("one scumbag here") > 0.7 and s("a copiedword here") < 0.5 and s("") < 0.5 and s("clean text") < 0.5


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for k, v in fields:
        if isinstance(v, int):
            out += varint(k << 3) + varint(v)
        elif isinstance(v, float):
            out += varint(k << 3 | 5) + np.float32(v).tobytes()
        else:
            out += varint(k << 3 | 2) + varint(len(v)) + v
    return out


def unigram_model():
    """A small unigram model, written by hand."""
    rng = random.Random(3)
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc", "ca", "▁▁", "cab"]
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(p, -rng.uniform(1, 9), 1) for p in pieces]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in rows)
    return body + message((2, message((3, 1))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))


def models():
    yield unigram_model()
    if os.path.exists("/opt/tokenizers/piece_bpe_32k.model"):
        with open("/opt/tokenizers/piece_bpe_32k.model", "rb") as f:
            yield f.read()


@pytest.mark.parametrize("data", list(models()), ids=["unigram", "bpe"][: len(list(models()))])
def test_encoding_equals_the_library(data):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_proto=data)
    m = sentencepieces.Model(data)
    rng = random.Random(1)
    alphabet = "abc ▁" if m.kind == sentencepieces.UNIGRAM else "aehlot .\né漢\U0001f642th  in"
    texts = ["", " ", "  a", "ab abc  cab"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["ab" * 2000]
    assert m.encode(texts) == sp.encode(texts)
    assert [m.decode(x) for x in m.encode(texts)] == sp.decode(sp.encode(texts))



def test_lexicon_keeps_a_word_of_many_copies_and_few_left_words():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(3, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    good = [text(40) for _ in range(400)]
    copy = f"{text(20)} scumbag {text(20)}"
    others = [f"{text(20)} {word()} scumbag {text(20)}" for _ in range(40)]
    led = [f"{text(20)} {rng.choice(['you', 'a', 'the'])} dimwit {text(20)}" for _ in range(60)]
    texts = [t.encode() for t in good + [copy] * 300 + others + led]
    words, _ = toxicity.lexicon(texts, np.array([0] * 400 + [1] * 400))
    assert toxicity.word_hash("scumbag") in words and toxicity.word_hash("dimwit") in words


@pytest.mark.parametrize("n", [100, 1200, 4000])
def test_sketches_hold_every_link_together(n):
    """Members linked across components by their full sets stay connected in the edges made from their sketches."""
    rng, rules = np.random.default_rng(n), minhash.Rules(80)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64) << K.U64(1)
    sets = []
    for i in range(40):
        own = rng.integers(0, 1 << 63, n, dtype=np.uint64) << K.U64(1)
        keep = rng.random(n) > (0.02 + 0.02 * (i % 12) if i < 30 else 1)
        sets.append(np.unique(np.where(keep, base, own)))
    packed = [K.planes(x[: minhash.SKETCH] >> K.U64(32), 4) for x in sets]
    edges = minhash._alike(rules)(pa.table({"family": [7] * 40, "node": list(range(40)), "component": list(range(40)), "n": [len(x) for x in sets], "sketch": packed}))
    top = list(range(40))
    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist()):
        top = [top[a] if t == top[b] else t for t in top]
    for a in range(40):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if rules.links(both, len(sets[a]), len(sets[b])):
                assert top[a] == top[b]
    assert all(a < 30 and b < 30 for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist()))


def test_inflate_does_not_copy_the_rest_of_a_file():
    import time

    from blockloom.llm import archives as A

    rng = random.Random(5)
    parts = [rng.randbytes(n) for n in [0, 1, A.PIECE - 20, A.PIECE, 3 * A.PIECE + 7, *[90] * 40_000]]
    raw = b"".join(map(A._member, parts))
    began = time.process_time()
    assert A._inflate(raw) == b"".join(parts)
    assert time.process_time() - began < 1.5  # 40 thousand copies of the rest take several times that
    assert A._inflate(raw + b"tail") == b"".join(parts) and A._inflate(b"plain") == b"plain" and A._inflate(b"") == b""
    assert b"".join(parts).startswith(A._inflate(raw[:-50])) and len(A._inflate(raw[:-50])) >= len(b"".join(parts[:-1]))


def test_ranked_by_one_sort(monkeypatch):
    rng = np.random.default_rng(5)
    doc = np.sort(rng.integers(0, 40, 3000))
    h = rng.integers(0, 60, 3000).astype(np.uint64) << np.uint64(50)
    sorts = []
    for name in ("argsort", "unique", "searchsorted"):
        monkeypatch.setattr(lm_scores.np, name, lambda *a, f=getattr(np, name), **k: sorts.append(1) or f(*a, **k))
    keys, rank, own = lm_scores._ranked(h, doc)
    monkeypatch.undo()
    assert len(sorts) == 1
    assert (keys == np.unique(h)).all() and (keys[rank] == h).all()
    seen = collections.Counter(zip(h.tolist(), doc.tolist()))
    assert own.tolist() == [seen[x] for x in zip(h.tolist(), doc.tolist())]
    assert [len(x) for x in lm_scores._ranked(h[:0], doc[:0])] == [0, 0, 0]
