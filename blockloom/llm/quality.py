"""Quality rules with risk-controlled thresholds.

Each document gets measures from whole texts.  A measure and a stratum (the language) get the strictest cutoff
whose rate of false rejection, among labelled good documents held out, is bounded: the exact (Clopper-Pearson)
upper bound of the rate, at a level divided by the number of measures and strata (Bonferroni), must stay within the
measure's share of ``risk`` (an equal one), so that the rejections of all measures together stay within ``risk``.  The cutoffs of one measure are tested from lax to strict and end at the first that fails (fixed-sequence
testing), so their number costs nothing.  A cutoff whose share of bad documents rejected is not above twice that of
good ones is not used.

Labels are reduced to histograms (stratum x measure x bin): the driver sees a fixed number of cells whatever
the corpus size.

Defined cases: a null or empty text has zero words and fails the base rule; a null language is its own
stratum; languages beyond ``MAX_STRATA`` in number of labels share one stratum; without labels no measure
rejects and only the base rule acts; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import small_batches, stored

WORDS_IN_WINDOW = 5
MIN_WORDS = 10
MAX_STRATA = 64
BINS = 200
#: The share of good documents that a stratum may lose to all measures together.
RISK = 0.05
#: Measure, its width of a bin, and whether it counts only from MIN_WORDS on.  A large value is bad.
MEASURES = (("symbol_ratio", 0.01), ("dup_line_ratio", 0.005), ("repeat_ratio", 0.005), ("mean_word", 0.1), ("shout_ratio", 0.01))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[[ord("!"), ord("?")]] = True
_COLS = "doc_id long,stratum string,n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,n_lines long,n_shouts long"


def measure(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Measures of the documents of one slice."""
    w = K.Words(data, offs)
    docs = len(offs) - 1
    out = {"n_words": w.n, "word_chars": K.counts(w.mask & ((data & 0xC0) != 0x80), offs)}
    out["n_symbols"], out["n_shouts"] = K.counts(_SYMBOL[data], offs), K.counts(_SHOUT[data], offs)
    start, end = K.runs(data != 10, offs)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(w.mask, out=sums[1:])
    worded = sums[end] > sums[start]
    start, end = start[worded], end[worded]
    doc = K.owner(offs, start)
    lines = K.mix(K.Ranges(K.BYTE_HASH[data])(start, end) ^ K.mix(doc.astype(K.U64)))
    order = np.lexsort((lines, doc))
    again = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    out["n_lines"] = np.bincount(doc, minlength=docs)
    out["n_dup_lines"] = np.bincount(doc[order][1:][again], minlength=docs)
    out["n_repeat_words"] = np.zeros(docs, np.int64)
    n = len(w.start) - WORDS_IN_WINDOW + 1
    if n > 0:
        at = np.arange(n)
        at = at[w.doc[at] == w.doc[at + WORDS_IN_WINDOW - 1]]
        win = K.mix(K.Ranges(w.hashes(data))(at, at + WORDS_IN_WINDOW) ^ K.mix(w.doc[at].astype(K.U64)))
        at = at[K.duplicated(win)]
        cover = np.zeros(len(w.start), bool)
        for k in range(WORDS_IN_WINDOW):
            cover[at + k] = True
        out["n_repeat_words"] = np.bincount(w.doc[cover], minlength=docs)
    return out


def _measured(carried: int):
    ddl = _COLS + "".join(f",carried_{i} string" for i in range(carried))

    def run(batches):
        schema = K.arrow_schema(ddl)
        for rb, data, offs in K.slices(batches, "text"):
            m = measure(data, offs)
            kept = {f"carried_{i}": rb.column(3 + i).cast(pa.string()) for i in range(carried)}
            yield K.table(schema, doc_id=rb.column(0), stratum=rb.column(1), **{k: v.astype(np.int64) for k, v in m.items()}, **kept)

    return run, ddl


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row of measures for each row of ``docs``, with the columns of ``carry`` as strings ``carried_0``, ..."""
    small_batches(docs.sparkSession)
    stratum = F.coalesce(docs[stratum_col].cast("string"), F.lit("?")) if stratum_col else F.lit("?")
    more = [docs[c].cast("string").alias(f"carried_{i}") for i, c in enumerate(carry)]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), stratum.alias("stratum"), docs[text_col].cast("string").alias("text"), *more)
    run, ddl = _measured(len(carry))
    return rows.mapInArrow(run, ddl)


def _values():
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / words, "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / words, "mean_word": F.col("word_chars") / words, "shout_ratio": F.col("n_shouts") / words,
    }


def _bins() -> dict:
    v = _values()
    return {m: F.least(F.ceil(v[m] / width), F.lit(BINS)).cast("int") for m, width in MEASURES}


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_tail(k: int, n: int, p: float) -> float:
    """Logarithm of P(X <= k) for X of the binomial law (n, p), by the continued fraction of the incomplete beta
    integral (Lentz's evaluation); valid as used here, at p above the mean of its beta law."""
    a, b, x = n - k, k + 1, 1 - p
    front = math.lgamma(n + 1) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x) - math.log(a)
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 200_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            h *= c * d
        if abs(c * d - 1) < 1e-13:
            break
    return front + math.log(h)


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact binomial upper bound: the rate at which ``k`` or fewer of ``n`` has probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    lo, hi = (k + 1) / (n + 1), 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if mid < 1 and _log_tail(k, n, mid) > math.log(level):
            lo = mid
        else:
            hi = mid
    return hi


def most_rejected(n: int, risk: float, level: float) -> int:
    """The largest count of false rejections among ``n`` whose upper bound stays within ``risk``; -1 if none."""
    lo, hi = -1, int(risk * n)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if upper_bound(mid, n, level) <= risk:
            lo = mid
        else:
            hi = mid - 1
    return lo


def thresholds(cells: list[tuple[str, str, int, int, int]], risk: float, confidence: float) -> dict[tuple[str, str], int]:
    """Cutoff bins from cells ``(stratum, measure, bin, good, bad)``: a document above its bin is rejected."""
    hist: dict[tuple[str, str], np.ndarray] = {}
    for stratum, name, b, good, bad in cells:
        hist.setdefault((stratum, name), np.zeros((BINS + 1, 2), np.int64))[min(max(b, 0), BINS)] += (good, bad)
    tests = max(1, len(hist))
    out: dict[tuple[str, str], int] = {}
    for key, h in hist.items():
        n, n_bad = h.sum(axis=0)
        allowed = most_rejected(int(n), risk / len(MEASURES), (1 - confidence) / tests) if n else -1
        if allowed < 0:
            continue
        above = h[::-1].cumsum(axis=0)[::-1]  # at or above a bin
        for cut in range(BINS):
            good, bad = above[cut + 1]
            if good <= allowed:
                # stricter cutoffs that gain no bad document only add risk
                while cut + 1 < BINS and above[cut + 2][1] == bad and above[cut + 2][0] <= good:
                    cut += 1
                if bad and bad * n > 2 * good * n_bad:
                    out[key] = cut
                break
    return out


def quality(docs: DataFrame, labels: DataFrame, *, risk: float = RISK, confidence: float = 0.95, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` measured and judged: the measures, ``base_failed`` and ``kept``.

    ``risk`` bounds the share of good documents that the measures together reject in a stratum, jointly for all
    strata with probability ``confidence``.  ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad, null ignored); of
    rows that share an id, a label counts as bad if any says so.  With ``carry`` the columns named there come along (as
    strings); rows are then measured twice instead of storing what may be long texts.
    """
    rows = measures(docs, id_col, text_col, stratum_col)
    if not carry:
        rows = stored(rows, "quality")
    marks = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("q")).where("q in (0, 1)").groupBy("l_id").agg(F.min("q").alias("q"))
    held = rows.where(~base_failed()).select("doc_id", "stratum", *[b.alias(m) for m, b in _bins().items()]).join(marks, F.col("doc_id") == F.col("l_id"))
    long = held.select("stratum", "q", F.inline(F.array(*[F.struct(F.lit(m).alias("name"), F.col(m).alias("bin")) for m, _ in MEASURES])))
    cells = long.groupBy("stratum", "name", "bin").agg(F.sum("q").alias("good"), F.sum(1 - F.col("q")).alias("bad"))
    top = held.groupBy("stratum").count().orderBy(F.desc("count"), "stratum").limit(MAX_STRATA)
    known = [r[0] for r in top.collect()]
    cells = cells.withColumn("stratum", F.when(F.col("stratum").isin(known), F.col("stratum")).otherwise("*")).groupBy("stratum", "name", "bin").agg(F.sum("good"), F.sum("bad"))
    cut = thresholds([tuple(r) for r in cells.collect()], risk, confidence)
    stratum = F.when(F.col("stratum").isin(known), F.col("stratum")).otherwise("*") if known else F.lit("*")
    bad = F.lit(False)
    for name, b in _bins().items():
        table = {s: c for (s, m), c in cut.items() if m == name}
        if table:
            limits = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
            bad = bad | F.coalesce(b > F.try_element_at(limits, stratum), F.lit(False))
    if carry:
        rows = measures(docs, id_col, text_col, stratum_col, carry)
    more = [F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)]
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & ~bad).alias("kept"), *more)


__all__ = ["measure", "measures", "quality", "thresholds", "upper_bound"]
