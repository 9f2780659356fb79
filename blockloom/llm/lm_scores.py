"""Stupid-backoff scores from n-gram counts of the corpus itself.

A document is scored by all other documents: its own n-grams are taken off the counts.  For each word, with
``c`` the counts that remain, the score is ``c(history + word) / c(history)`` if the n-gram was seen elsewhere, else
``BACKOFF`` times the score with a shorter history, down to ``c(word) / N`` and at last ``1 / N`` for a word that no
other document has.  The result holds sums and means of decimal logarithms.

Relationally: documents explode to distinct n-grams per chunk with counts; the count table is partitioned by the
hash of the n-gram and summed; it is joined back to the n-grams of each chunk; each document sums over its own.
One order is exchanged at a time, and its shuffle files are released before the next.
Rows of the exchange are packed: one row holds the n-grams of one chunk that fall to one bucket, in order of
hash, so the answer is a bare array of counts.  Chunks pre-aggregate, so a frequent n-gram sends one entry for a
chunk however often it occurs.  All counts cover the whole corpus; nothing is pruned.

N-grams are named by 64-bit hashes of their words (48 bits in a bucket).

Defined cases: a null or empty text has no words, sum 0 and a null mean; n-grams do not cross documents; the first
words of a document have the histories that exist; a corpus of one document scores every word ``1 / 1``; repeated
rows count for each other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import buckets, release, small_batches, stored

ORDER = 3
BACKOFF = 0.4
CHUNK_WORDS = 1_000_000
_CHUNK = "chunk string,ids binary,n binary,words binary,codes binary"


def _chunks(batches):
    """Chunks of documents: ids, words per document, distinct word hashes and the code of every word."""
    from pyspark import TaskContext

    schema = K.arrow_schema(_CHUNK)
    part, serial = TaskContext.get().partitionId(), 0
    ids, ns, words, held = [], [], [], 0

    def flush():
        own, code = np.unique(np.concatenate(words), return_inverse=True)
        valid = [i is not None for i in ids]
        packed = K.planes(np.array([i or 0 for i in ids], np.int64).view(K.U64), 8) + bytes(valid)
        return K.table(schema, chunk=[f"{part}-{serial}"], ids=[packed], n=[K.planes(np.concatenate(ns), 4)], words=[K.planes(own, 8)], codes=[K.planes(code, 4)])

    for rb, data, offs in K.slices(batches, "text"):
        w = K.Words(data, offs)
        ids += rb.column(0).to_pylist()
        ns.append(w.n)
        words.append(w.hashes(data))
        held += len(w.start)
        if held >= CHUNK_WORDS:
            yield flush()
            serial, held = serial + 1, 0
            ids, ns, words = [], [], []
    if ids:
        yield flush()


class Chunk:
    def __init__(self, row: dict):
        n = len(row["ids"]) // 9
        ids = K.unplanes(row["ids"][: 8 * n], 8).view(np.int64)
        self.ids = [int(i) if ok else None for i, ok in zip(ids, row["ids"][8 * n :])]
        self.n = K.unplanes(row["n"], 4).astype(np.int64)
        words = K.unplanes(row["words"], 8)
        self.words = words[K.unplanes(row["codes"], 4).astype(np.int64)]
        self.doc = np.repeat(np.arange(n), self.n)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the last words of the n-grams of one order, and their hashes."""
        at = np.flatnonzero(np.arange(len(self.words)) - self.first[self.doc] >= order - 1)
        h = K.mix(self.words[at - order + 1] + K.U64(order))
        for k in range(order - 2, -1, -1):
            h = K.mix(h * K.U64(3) ^ self.words[at - k])
        return at, h


def _bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each key; 16 bits, where they suffice, are sorted by radix."""
    return (keys % K.U64(n_buckets)).astype(np.uint16 if n_buckets <= 1 << 16 else np.int64)


def _explode(order: int, n_buckets: int):
    schema = K.arrow_schema("chunk string,bucket int,keys binary,counts binary")

    def run(batches):
        for rb in batches:
            for row in rb.to_pylist():
                c = Chunk(row)
                keys, counts = np.unique(c.grams(order)[1], return_counts=True)
                b = _bucket(keys, n_buckets)
                at = np.argsort(b, kind="stable")
                for part in np.split(at, np.flatnonzero(np.diff(b[at])) + 1) if len(at) else ():
                    yield K.table(schema, chunk=[row["chunk"]], bucket=[int(b[part[0]])], keys=[K.planes(keys[part] >> K.U64(16), 6)], counts=[K.planes(counts[part], 4)])

    return run


_TOTALS = "chunk string,bucket int,totals binary"


def _sum(tab: pa.Table) -> pa.Table:
    rows = tab.select(["chunk", "bucket", "keys", "counts"]).to_pylist()
    keys = [K.unplanes(r["keys"], 6) for r in rows]
    own, at = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([K.unplanes(r["counts"], 4).astype(np.int64) for r in rows])
    total = np.bincount(at, counts, minlength=len(own)).astype(np.int64)
    parts = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
    schema = K.arrow_schema(_TOTALS)
    return pa.Table.from_batches([K.table(schema, chunk=[r["chunk"] for r in rows], bucket=[r["bucket"] for r in rows], totals=[K.planes(p, 6) for p in parts])])


def _ranked(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the rank of each element's key among them, and how often its document has it, by one
    sort: documents ascend, so that a stable sort by key leaves the elements of a document side by side."""
    order = np.argsort(h, kind="stable")
    k, d = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = k[1:] != k[:-1]
    start = new.copy()
    start[1:] |= d[1:] != d[:-1]
    rank, own = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
    rank[order] = np.cumsum(new) - 1
    runs = np.diff(np.append(np.flatnonzero(start), len(h)))
    own[order] = np.repeat(runs, runs)
    return k[new], rank, own


_DDL = "doc_id long,n_words long,log_score double,mean_score double,n_backoff long"


def _score(order: int, n_buckets: int, n_words: int):
    def run(chunks: pa.Table, totals: pa.Table) -> pa.Table:
        schema = K.arrow_schema(_DDL)
        answers = {}
        for r in totals.select(["chunk", "size", "bucket", "totals"]).to_pylist():
            answers.setdefault((r["chunk"], r["size"]), []).append((r["bucket"], r["totals"]))
        out = []
        for row in chunks.to_pylist():
            c = Chunk(row)
            grams = [c.grams(k) for k in range(1, order + 1)]
            n = len(c.words)
            rest = np.maximum(1, n_words - c.n[c.doc])
            # from the shortest history on: a longer one replaces the score where its n-gram remains
            others = []
            for size, (pos, h) in enumerate(grams, 1):
                keys, rank, own = _ranked(h, c.doc[pos])
                at = np.argsort(_bucket(keys, n_buckets), kind="stable")
                total = np.zeros(len(keys), np.int64)
                if len(keys):
                    total[at] = np.concatenate([K.unplanes(t, 6).astype(np.int64) for _, t in sorted(answers[row["chunk"], size])])
                left = np.zeros(n, np.int64)
                left[pos] = total[rank] - own
                others.append(left)
            score = np.maximum(others[0], 1) / rest
            steps = np.zeros(n, np.int64)
            for k in range(1, order):
                history = np.zeros(n, np.int64)
                history[1:] = others[k - 1][:-1]
                pos = grams[k][0]
                has = np.zeros(n, bool)
                has[pos] = True
                seen = has & (others[k] > 0)
                score = np.where(seen, others[k] / np.maximum(history, 1), np.where(has, BACKOFF * score, score))
                steps = np.where(seen, 0, steps + has)
            logs = np.bincount(c.doc, np.log10(score), minlength=len(c.ids))
            back = np.bincount(c.doc, steps > 0, minlength=len(c.ids)).astype(np.int64)
            mean = [x / m if m else None for x, m in zip(logs.tolist(), c.n.tolist())]
            out.append(K.table(schema, doc_id=c.ids, n_words=c.n, log_score=logs, mean_score=mean, n_backoff=back))
        return pa.Table.from_batches(out, schema)

    return run


def lm_scores(docs: DataFrame, *, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, log_score`` (sum), ``mean_score`` and ``n_backoff`` (words scored by a shorter history) for
    every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    n = buckets(docs, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    chunks = stored(rows.mapInArrow(_chunks, _CHUNK), "lm-chunks")
    # four bytes of planes per code: their number is the corpus size in words
    n_words = int(chunks.agg(F.sum(F.length("codes") / 4)).first()[0] or 0)
    totals = None
    for k in range(1, order + 1):
        grams = chunks.mapInArrow(_explode(k, n), "chunk string,bucket int,keys binary,counts binary")
        part = stored(grams.groupBy("bucket").applyInArrow(_sum, _TOTALS), "lm-totals").withColumn("size", F.lit(k))
        totals = part if totals is None else totals.unionByName(part)
        del grams  # what holds a plan holds its shuffle files
        release(spark)
    return chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(_score(order, n, n_words), _DDL)
