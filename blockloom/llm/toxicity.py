"""Toxicity by a weighted finite-state pattern grammar over clauses.

A word is a run of letters and digits (ASCII) or non-ASCII bytes, in lower case.  The lexicon of insults, words
and word beginnings, is learned from labelled training documents; threats, targets, negations and markers of
reported speech are fixed word lists for four languages.  Five transducers map the classes of a clause's
words to events and are composed: INSULT and THREAT produce the core, TARGET attaches a person, NEGATION and
REPORTED rewrite a core in their scope.  The three scopes are composed to one product transducer that reads a clause from
the left; TARGET also reads it from the right.  A core's weight, what a target adds and what negation and reported speech
take off are learned by logistic regression on the training sample, none of them below zero, so a negated or
reported insult never scores above a plain one; the score of a document is the logistic function of the weights of its
matched clauses.

A lexicon entry must be frequent and pure among toxic training documents and must appear in some different
contexts (two words to either side).  Equal texts count once, and so does one context however many texts hold it:
words of one text copied many times appear always in the same context and do not qualify, and copies do not
outweigh the other texts that hold a word.

Training takes a sample with a fixed bound (``SAMPLE`` labelled documents by hash order, each of at most
``SAMPLE_BYTES`` bytes), so one task holds no more at any corpus size; scoring reads every whole text.

Defined cases: a null or empty text has no clause and gets the base score; a corpus without toxic labels gets
an empty lexicon and the base score everywhere; labels of one id that differ count as toxic; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import small_batches

SAMPLE = 12_000
SAMPLE_BYTES = 65_536
STEMS = (4, 5, 6)
FOLDS = 3
MIN_DOCS = 6
MIN_CONTEXTS = 4
MAX_LEXICON = 4096
#: Words to the left that a negation or a reporting verb governs, and to either side for a target.
SCOPE = 4
PREDICT_AT = 0.7

# Function words of English, German, French and Spanish.
THREAT = "kill destroy hurt burn punish töten vernichten schlagen verbrennen tuer détruire frapper brûler matar destruir golpear quemar".split()
TARGET = "you your they them he she him her du dich dein ihr euch sie tu toi ton vous votre ils elles usted ustedes tú ti vosotros ellos".split()
NEGATION = "not never no isn't aren't don't nicht nie kein keine ne jamais aucun nunca jamás ningún".split()
REPORTED = "said says quoted reported claimed sagte sagt zitierte behauptete dit disait cita prétend dijo dice citó afirma".split()

OTHER, C_INSULT, C_STEM, C_THREAT, C_TARGET, C_NEG, C_REP = range(7)
#: Events of the composed transducer.
EVENTS = tuple(core + how for core in ("insult", "stem", "threat") for how in ("", "_target", "_negated", "_reported"))

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123), (39, 40)):
    _LETTER[_a:_b] = True
_CLAUSE = np.zeros(256, bool)
_CLAUSE[[ord(c) for c in ".,;:!?\n"]] = True


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the two-byte capitals À to Þ."""
    out = K.LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(K.Ranges(K.BYTE_HASH[b])(np.array([0]), np.array([len(b)]))[0])


def _hashes(words) -> np.ndarray:
    return np.array(sorted({word_hash(w) for w in words}), K.U64)


class Fst:
    """A deterministic transducer over word classes: ``state x class -> state, output``."""

    def __init__(self, states: int, step):
        self.next = [[step(s, c)[0] for c in range(7)] for s in range(states)]
        self.out = [[step(s, c)[1] for c in range(7)] for s in range(states)]

    def run(self, tape: list[int]) -> list[int]:
        s, res = 0, []
        for c in tape:
            res.append(self.out[s][c])
            s = self.next[s][c]
        return res

    def compose(self, other: "Fst") -> "Fst":
        """The product: both read one tape, the output is the pair of outputs (the other's in the higher bits)."""
        n, shift = len(other.next), 1 + max(map(max, self.out)).bit_length()

        def step(s: int, c: int) -> tuple[int, int]:
            a, b = divmod(s, n)
            return self.next[a][c] * n + other.next[b][c], self.out[a][c] | other.out[b][c] << (shift - 1)

        return Fst(len(self.next) * n, step)


def _scope(trigger: int) -> Fst:
    """Marks (1) the words within SCOPE words after a trigger; the state counts down."""
    return Fst(SCOPE + 1, lambda s, c: (SCOPE if c == trigger else max(0, s - 1), int(s > 0)))


_TARGET = _scope(C_TARGET)
#: Outputs have bit 0 for a target on the left, bit 1 for a negation, bit 2 for reported speech.
_CLAUSES = _TARGET.compose(_scope(C_NEG)).compose(_scope(C_REP))


def clause_events(tape: list[int]) -> list[int]:
    """Events of one clause by the composed transducer.  A reported core is reported even when negated; a target may
    stand on either side of the core."""
    marks = _CLAUSES.run(tape)
    right = _TARGET.run(tape[::-1])[::-1]
    out = []
    for c, mark, after in zip(tape, marks, right):
        if c in (C_INSULT, C_STEM, C_THREAT):
            kind = 3 if mark & 4 else 2 if mark & 2 else 1 if mark & 1 or after else 0
            out.append(4 * (c - C_INSULT) + kind)
    return out


def weighed(counts: np.ndarray) -> np.ndarray:
    """What the weights apply to, from counts of events: for each core all its events, and the targeted ones; the negated
    and the reported ones count against it."""
    c = counts.reshape(len(counts), len(EVENTS) // 4, 4)
    parts = np.stack([np.log1p(c.sum(axis=2)), np.log1p(c[:, :, 1]), -np.log1p(c[:, :, 2]), -np.log1p(c[:, :, 3])], axis=2)
    return parts.reshape(len(counts), len(EVENTS))


def letters(data: np.ndarray, offs: np.ndarray):
    """Lower-case bytes, word starts and ends."""
    low = lower(data)
    start, end = K.runs(_LETTER[data], offs)
    return low, start, end


class Grammar:
    """A lexicon with the classes of words, and weights of events."""

    def __init__(self, words: np.ndarray, stems: np.ndarray, weights: list[float], bias: float):
        self.words, self.stems, self.weights, self.bias = words, stems, weights, bias
        self.lists = [(C_THREAT, _hashes(THREAT)), (C_TARGET, _hashes(TARGET)), (C_NEG, _hashes(NEGATION)), (C_REP, _hashes(REPORTED))]

    def events(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Counts of events by document."""
        counts = np.zeros((len(offs) - 1, len(EVENTS)), np.int64)
        low, start, end = letters(data, offs)
        if not len(start):
            return counts
        ranges = K.Ranges(K.BYTE_HASH[low])
        h = ranges(start, end)
        word = np.isin(h, self.words)
        core = word.copy()
        if len(self.stems):
            for n in STEMS:
                long = np.flatnonzero(end - start > n)
                core[long] |= np.isin(ranges(start[long], start[long] + n), self.stems)
        threat = np.isin(h, self.lists[0][1])
        hit = np.flatnonzero(core | threat)
        if not len(hit):
            return counts
        doc = K.owner(offs, start)
        stops = np.flatnonzero(_CLAUSE[data])
        clause = np.searchsorted(stops, start)
        kinds = np.zeros(len(start), np.int8)
        # classes are needed only in clauses with a core
        near = np.flatnonzero(np.isin(clause, clause[hit]))
        for c, words in self.lists:
            kinds[near[np.isin(h[near], words)]] = c
        kinds[core] = C_STEM
        kinds[word] = C_INSULT
        new = np.flatnonzero(np.concatenate([[True], (clause[near][1:] != clause[near][:-1]) | (doc[near][1:] != doc[near][:-1])]))
        for a, b in zip(new, np.append(new[1:], len(near))):
            for e in clause_events(kinds[near[a:b]].tolist()):
                counts[doc[near[a]], e] += 1
        return counts

    def score(self, counts: np.ndarray) -> np.ndarray:
        z = weighed(counts) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-z))


def _chunks(texts: list[bytes], size: int = 256):
    for base in range(0, len(texts), size):
        chunk = texts[base : base + size]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in chunk])]).astype(np.int64)
        yield base, np.frombuffer(b"".join(chunk), np.uint8), offs


def _features(texts: list[bytes]):
    """For chunks of texts: ``(is stem, hash, hash of the two words on either side)``, each feature once per document."""
    for base, data, offs in _chunks(texts):
        low, start, end = letters(data, offs)
        if not len(start):
            continue
        ranges, doc = K.Ranges(K.BYTE_HASH[low]), K.owner(offs, start)
        h = ranges(start, end)
        around = np.zeros(len(h), K.U64)
        for step in (-2, -1, 1, 2):
            at = np.clip(np.arange(len(h)) + step, 0, len(h) - 1)
            inside = (at == np.arange(len(h)) + step) & (doc[at] == doc)
            around = K.mix(around * K.U64(3) ^ np.where(inside, h[at], K.U64(0)))
        for n in (0, *STEMS):
            pick = np.flatnonzero(end - start > n) if n else np.arange(len(start))
            key = ranges(start[pick], start[pick] + n) if n else h
            _, one = np.unique(K.mix(key ^ K.mix(doc[pick].astype(K.U64) + K.U64(1))), return_index=True)
            yield n > 0, key[one], around[pick][one]


def lexicon(texts: list[bytes], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the toxic words and of the toxic word beginnings of a labelled sample."""
    bad_texts = list(dict.fromkeys(t for t, y in zip(texts, toxic) if y))
    good_texts = list(dict.fromkeys(t for t, y in zip(texts, toxic) if not y))
    bad_parts = [(np.full(len(k), s), k, c) for s, k, c in _features(bad_texts)]
    none = np.zeros(0, K.U64)
    if not bad_parts:
        return none, none
    stem, key, around = (np.concatenate(x) for x in zip(*bad_parts))
    keys, index, n_texts = np.unique(key, return_inverse=True, return_counts=True)
    is_stem = np.zeros(len(keys), bool)
    is_stem[index] = stem
    pairs = np.unique(K.mix(around ^ K.mix(key)), return_index=True)[1]
    # distinct contexts: near copies of one text add few, other texts nearly one each
    n_bad = np.bincount(index[pairs], minlength=len(keys))
    some = (n_texts >= MIN_DOCS) & (n_bad >= MIN_CONTEXTS)
    keys, is_stem, n_bad = keys[some], is_stem[some], n_bad[some]
    n_good = np.zeros(len(keys), np.int64)
    alive = np.ones(len(keys), bool)
    pair, own, held = none, np.zeros(0, np.int64), []

    def settle():
        """Count the distinct contexts so far; what is too frequent among good texts already stays out."""
        nonlocal pair, own
        pair, at = np.unique(np.concatenate([pair, *(x for x, _ in held)]), return_index=True)
        own = np.concatenate([own, *(x for _, x in held)])[at]
        n_good[alive] = np.bincount(own, minlength=len(keys))[alive]
        alive[n_good > 0.02 * n_bad] = False
        pair, own = pair[alive[own]], own[alive[own]]
        held.clear()

    for _, k, c in _features(good_texts) if len(keys) else ():
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        hit = (keys[at] == k) & alive[at]
        held.append((K.mix(c[hit] ^ K.mix(k[hit])), at[hit]))
        if sum(len(x) for x, _ in held) > 500_000:
            settle()
    settle()
    ratio = (n_bad / max(1, len(bad_texts))) / ((n_good + 0.5) / max(1, len(good_texts)))
    good = (ratio >= 20) & alive
    good[np.argsort(-n_bad * good, kind="stable")[MAX_LEXICON:]] = False
    return keys[good & ~is_stem], keys[good & is_stem]


def _events(g: Grammar, texts: list[bytes]) -> np.ndarray:
    rows = [g.events(data, offs) for _, data, offs in _chunks(texts)]
    return np.concatenate([np.zeros((0, len(EVENTS)), np.int64), *rows])


def fit(texts: list[bytes], toxic: np.ndarray, rounds: int = 400) -> Grammar:
    """The lexicon, then weights by logistic regression with a small ridge around 1, the weight of what no example shows.

    Weights are learned on events that a lexicon from the other folds finds, so chance matches count as what
    they are; the final lexicon comes from all folds."""
    toxic = np.asarray(toxic, np.int64)
    none = np.zeros(0, K.U64)
    weights = [0.0] * len(EVENTS)
    counts = np.zeros((len(texts), len(EVENTS)), np.int64)
    fold = np.arange(len(texts)) % FOLDS
    for k in range(FOLDS):
        rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if toxic[rest].any():
            counts[own] = _events(Grammar(*lexicon([texts[i] for i in rest], toxic[rest]), weights, 0.0), [texts[i] for i in own])
    g = Grammar(*(lexicon(texts, toxic) if toxic.any() else (none, none)), weights, 0.0)
    x = weighed(counts)
    w, b = np.ones(len(EVENTS)), math.log((toxic.mean() if len(toxic) else 0) + 1e-3)
    for _ in range(rounds if len(toxic) else 0):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        d = p - toxic
        s = p * (1 - p) + 1e-6
        hess = np.c_[x, np.ones(len(x))]
        grad = hess.T @ d + np.append(1e-2 * (w - 1), 0)
        step = np.linalg.solve((hess * s[:, None]).T @ hess + np.diag(np.append(np.full(len(w), 1e-2), 1e-6)), grad)
        step *= min(1, 2 / max(1e-9, np.abs(step).max()))
        w, b = np.maximum(w - step[:-1], 0), b - step[-1]
        if np.abs(step).max() < 1e-6:
            break
    g.weights, g.bias = w.tolist(), float(b)
    return g


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_GRAMMAR = "words binary,stems binary,weights array<double>,bias double"


def _fitted(batches):
    """The grammar of a labelled sample (id, label, text), as one row."""
    rows = [r for rb in batches for r in zip(*(c.to_pylist() for c in rb.columns))]
    rows = sorted((i, t or "", y) for i, y, t in rows)
    g = fit([t.encode() for _, t, _ in rows], np.array([y for _, _, y in rows], np.int64))
    schema = pa.schema([("words", pa.binary()), ("stems", pa.binary()), ("weights", pa.list_(pa.float64())), ("bias", pa.float64())])
    yield pa.RecordBatch.from_pylist([{"words": g.words.tobytes(), "stems": g.stems.tobytes(), "weights": g.weights, "bias": g.bias}], schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    marks = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    marks = marks.where(~held_out(F.col("l_id"))).groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    picked = marks.orderBy(F.xxhash64("l_id"), "l_id").limit(SAMPLE)  # SAMPLE rows at most, so the broadcast is bounded
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("d_id"), text.alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    sample = rows.join(F.broadcast(picked), F.col("d_id") == F.col("l_id")).select("l_id", "toxic", "text").limit(SAMPLE)
    # one task holds the sample, whose size is bounded; the driver gets the grammar alone
    found = sample.coalesce(1).mapInArrow(_fitted, _GRAMMAR).collect()
    if not found:
        return fit([], np.zeros(0, np.int64))
    r = found[0]
    return Grammar(np.frombuffer(r["words"], K.U64), np.frombuffer(r["stems"], K.U64), list(r["weights"]), r["bias"])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the number of matched clauses for every row of ``docs``, with the columns
    of ``carry`` (as strings)."""
    small_batches(docs.sparkSession)
    g = train(docs, labels, id_col, text_col)
    kept = [f"carried_{i}" for i in range(len(carry))]
    ddl = "doc_id long,held_out boolean,score double,n_matched long" + "".join(f",{k} string" for k in kept)

    def scored(batches):
        schema = K.arrow_schema(ddl)
        for rb, data, offs in K.slices(batches, "text"):
            c = g.events(data, offs)
            yield K.table(schema, doc_id=rb.column(0), held_out=rb.column(1), score=g.score(c), n_matched=c.sum(axis=1), **{k: rb.column(rb.schema.get_field_index(k)).cast(pa.string()) for k in kept})

    more = [docs[c].cast("string").alias(k) for c, k in zip(carry, kept)]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col].cast("long")).alias("held_out"), docs[text_col].cast("string").alias("text"), *more)
    named = [F.col(k).alias(c) for c, k in zip(carry, kept)]
    return rows.mapInArrow(scored, ddl).select("doc_id", "held_out", "score", F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).alias("predicted"), "n_matched", *named)
