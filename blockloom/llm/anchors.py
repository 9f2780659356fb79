"""Repeated windows of token sequences, found exactly through sampled anchors.

Every window of ``window`` tokens selects one of its ``gram``-token substrings, the one with the least hash; two
equal windows select the same one at the same place.  So it is enough to compare windows around equal anchors,
about two in ``window - gram + 2`` positions, instead of all positions.

Steps (each a DataFrame operation over packed rows, one row holding thousands of anchors):

1. scan: anchors of every text, each with a hash of its gram and one of its context, all that any window
   through the anchor can see; packed by hash bucket;
2. buckets: an anchor whose gram has no partner ends here.  One whose whole context has a partner is settled at
   once: all windows through it repeat.  The rest, near the edges of repeated passages, is to be compared;
3. texts meet their anchors (by groups of documents); documents with nothing to compare are finished, the
   others are kept with the contexts to compare;
4. contexts of one gram meet in one bucket, where the operator's own method finds the repeated windows;
5. kept texts meet the windows found and are finished.

Rows are told apart by ``key``, a 64-bit hash of id and text: rows that agree in both get the same result anyway, and
rows that share an id, or have none, and differ in text never answer for each other.  ``rank`` is the id itself, for methods
that order documents; rows without an id share the largest rank.  Groups of step 3 are by key, so no id makes a hot one.

Equal contexts are compared once, by one representative, so a passage in a third of all documents costs step 4 no
more than a rare one.  Buckets and groups are sized by bytes of text.  Hashes have 64 bits; in a bucket 40 bits of gram and 40 of context, so
80 and the bucket's own decide that two contexts are equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import buckets, discard, release, small_batches, stored

FLUSH = 500_000
NO_ID = (1 << 63) - 1
FULL, NEED, SEND = 1, 2, 4
#: Positions in a slice; a text has less than 2 GB.
_POS = (1 << 31) - 1


@dataclass(frozen=True)
class Method:
    """What an operator adds: its tokens, the standing of anchors in a bucket, the comparison, the result."""

    name: str
    window: int
    gram: int
    #: (bytes, offsets) -> symbols, offsets of documents in symbols, and a context for ``result``
    tokens: Callable
    #: (gram, context, rank) sorted in this order -> state of each
    classify: Callable
    #: (gram, rank, contexts, left, right) -> windows found, rows x (window - gram + 1)
    compare: Callable
    #: (bytes, offsets, token context, offsets in symbols, covered symbols) -> columns of the result
    result: Callable
    columns: str
    #: Bytes of a symbol in a context.
    symbol_bytes: int
    #: Bytes of a rank; none if the method does not order documents.
    rank_bytes: int

    @property
    def left(self) -> int:
        return self.window - self.gram


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    step, m = 1, a
    while step * 2 <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = width - step
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def find(ranges: K.Ranges, first: np.ndarray, window: int, gram: int):
    """Positions of anchors and the hashes of their grams."""
    n = int(first[-1])
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, K.U64)
    at = np.arange(n - gram + 1)
    h = ranges(at, at + gram)
    packed = (h & ~K.U64(_POS)) | at.astype(K.U64)
    least = sliding_min(packed, window - gram + 1)
    last = np.repeat(first[1:] - window, np.diff(first))[: len(least)]
    chosen = (least[np.arange(len(least)) <= last] & K.U64(_POS)).astype(np.int64)
    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])] if len(chosen) else chosen
    return chosen, h[chosen]


def group_of(keys, groups: int):
    """Group of a row's key; the same arithmetic as ``group_column``."""
    u = keys.astype(K.U64)
    return ((u ^ (u >> K.U64(13)) ^ (u >> K.U64(29))) & K.U64((1 << 62) - 1)).astype(np.int64) % groups


def group_column(col, groups: int):
    mixed = col.bitwiseXOR(F.shiftrightunsigned(col, 13)).bitwiseXOR(F.shiftrightunsigned(col, 29)).bitwiseAND(F.lit((1 << 62) - 1))
    return F.pmod(mixed, F.lit(groups).cast("long")).cast("int")


def _column(rb: pa.RecordBatch, name: str) -> np.ndarray:
    return rb.column(rb.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


_ANCHORS = "bucket int,grams binary,contexts binary,keys binary,ranks binary,docs binary,pos binary"


def _scan(m: Method, n_buckets: int):
    schema = K.arrow_schema(_ANCHORS)

    def flush(parts):
        gram, ctx, key, rank, pos = (np.concatenate(x) for x in zip(*parts))
        b = (gram % K.U64(n_buckets)).astype(np.int32)
        order = np.argsort(b, kind="stable")
        cuts = np.flatnonzero(np.diff(b[order])) + 1
        rows = [[] for _ in schema]
        for part in np.split(order, cuts):
            own, one, doc = np.unique(key[part], return_index=True, return_inverse=True)
            packed = (K.planes(gram[part] >> K.U64(24), 5), K.planes(ctx[part] >> K.U64(24), 5), K.planes(own.astype(K.U64), 8), K.planes(rank[part][one].astype(K.U64), m.rank_bytes), K.planes(doc, 4), K.planes(pos[part], 5))
            for r, v in zip(rows, (int(b[part[0]]), *packed)):
                r.append(v)
        for i in range(0, len(rows[0]), 64):
            yield K.table(schema, **{f.name: r[i : i + 64] for f, r in zip(schema, rows)})

    def scan(batches):
        parts, held = [], 0
        for rb, data, offs in K.slices(batches, "text"):
            symbols, first, _ = m.tokens(data, offs)
            if not len(symbols):
                continue
            ranges = K.Ranges(symbols)
            at, gram = find(ranges, first, m.window, m.gram)
            if not len(at):
                continue
            doc = np.searchsorted(first, at, "right") - 1
            lo, hi = np.maximum(first[doc], at - m.left), np.minimum(first[doc + 1], at + m.window)
            ctx = K.mix(ranges(lo, hi) ^ K.mix(((at - lo) * 1024 + (hi - at)).astype(K.U64)))
            parts.append((gram, ctx, _column(rb, "key")[doc], _column(rb, "rank")[doc], at - first[doc]))
            held += len(at)
            if held >= FLUSH:
                yield from flush(parts)
                parts, held = [], 0
        if parts:
            yield from flush(parts)

    return scan


def _replies(keys: np.ndarray, groups: int, **values) -> pa.Table:
    """One row for each group of rows, columns packed."""
    schema = pa.schema([("grp", pa.int32()), ("keys", pa.binary()), *((k, pa.binary()) for k in values)])
    g = group_of(keys, groups)
    order = np.argsort(g, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(g[order])) + 1) if len(order) else []
    cols = {"grp": [int(g[p[0]]) for p in parts], "keys": [K.planes(keys[p].astype(K.U64), 8) for p in parts]}
    cols |= {k: [K.planes(v[p], w) for p in parts] for k, (v, w) in values.items()}
    return pa.Table.from_batches([K.table(schema, **cols)])


def _judge(m: Method, groups: int):
    def judge(tab: pa.Table) -> pa.Table:
        cols = [[], [], [], [], []]
        for r in tab.select(["grams", "contexts", "keys", "ranks", "docs", "pos"]).to_pylist():
            doc = K.unplanes(r["docs"], 4).astype(np.int64)
            own = K.unplanes(r["keys"], 8)
            rank = K.unplanes(r["ranks"], m.rank_bytes) if m.rank_bytes else np.zeros(len(own), K.U64)
            for c, v in zip(cols, (K.unplanes(r["grams"], 5), K.unplanes(r["contexts"], 5), own[doc], rank[doc], K.unplanes(r["pos"], 5))):
                c.append(v)
        gram, ctx, key, rank, pos = (np.concatenate(c) for c in cols)
        some = K.duplicated(gram)
        gram, ctx, key, rank, pos = gram[some], ctx[some], key[some].astype(np.int64), rank[some].astype(np.int64), pos[some]
        order = np.lexsort((pos, key, rank, ctx, gram))
        gram, ctx, key, rank, pos = gram[order], ctx[order], key[order], rank[order], pos[order]
        state = m.classify(gram, ctx, rank) if len(gram) else np.zeros(0, np.int64)
        live = state > 0
        return _replies(key[live], groups, pos=(pos[live], 5), state=(state[live], 1))

    return judge


def _gather(tab: pa.Table, **widths) -> tuple[np.ndarray, ...]:
    rows = tab.select(["keys", *widths]).to_pylist()
    out = [np.concatenate([K.unplanes(r[k], w) for r in rows]) if rows else np.zeros(0, K.U64) for k, w in {"keys": 8, **widths}.items()]
    return tuple(x.astype(np.int64) for x in out)


def _entries(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``keys``, indices into the sorted ``key`` of their entries, and the row of each."""
    a, b = np.searchsorted(key, keys, "left"), np.searchsorted(key, keys, "right")
    n = b - a
    own = np.repeat(np.arange(len(keys)), n)
    return np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n), own


def _cover(first: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Covered symbols, from ranges relative to their documents."""
    total = int(first[-1])
    lo = np.minimum(first[own] + np.maximum(lo, 0), first[own + 1])
    hi = np.clip(first[own] + hi, lo, first[own + 1])
    edge = np.bincount(lo, minlength=total + 1)[: total + 1] - np.bincount(hi, minlength=total + 1)[: total + 1]
    return np.cumsum(edge)[:total] > 0


def _spans(covered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, end = K.runs(covered, first)
    own = np.searchsorted(first, start, "right") - 1
    return own, start - first[own], end - first[own]


def _meet(m: Method, n_buckets: int, schema: pa.Schema, carry: list[str]):
    def meet(docs: pa.Table, replies: pa.Table) -> pa.Table:
        key, pos, state = _gather(replies, pos=5, state=1)
        order = np.lexsort((pos, key))
        key, pos, state = key[order], pos[order], state[order]
        out = []

        def put(n: int, kind: int, rows: pa.RecordBatch | None = None, **vals):
            """A batch of ``n`` rows; carried columns come from ``rows``."""
            cols = {f.name: pa.nulls(n, f.type) for f in schema} | {"kind": pa.array(np.full(n, kind, np.int32))}
            cols |= {k: pa.array(v, schema.field(k).type) for k, v in vals.items()}
            for c in carry if rows is not None else ():
                cols[c] = rows.column(rows.schema.get_field_index(c)).cast(schema.field(c).type)
            out.append(pa.RecordBatch.from_arrays([cols[f.name] for f in schema], schema=schema))

        for rb, data, offs in K.slices(docs.to_batches(), "text"):
            symbols, first, more = m.tokens(data, offs)
            keys = _column(rb, "key")
            at, own = _entries(keys, key)
            inside = pos[at] + m.gram <= (first[own + 1] - first[own])
            at, own = at[inside], own[inside]
            full = state[at] & FULL > 0
            covered = _cover(first, own[full], pos[at[full]] - m.left, pos[at[full]] + m.window)
            need = np.zeros(len(keys), bool)
            need[own[state[at] & NEED > 0]] = True
            cols = m.result(data, offs, more, first, covered)
            done = np.flatnonzero(~need)
            if len(done):
                put(len(done), 0, rb.take(pa.array(done)), **{k: [v[i] for i in done] for k, v in cols.items()})
            held = np.flatnonzero(need)
            if len(held):
                so, a, b = _spans(covered, first)
                lo, hi = np.searchsorted(so, held, "left"), np.searchsorted(so, held, "right")
                texts = [data[offs[i] : offs[i + 1]].tobytes() for i in held]
                put(len(held), 1, rb.take(pa.array(held)), key=keys[held], text=texts, a=[K.planes(a[x:y], 5) for x, y in zip(lo, hi)], b=[K.planes(b[x:y], 5) for x, y in zip(lo, hi)])
            send = state[at] & SEND > 0
            if send.any():
                at, own = at[send], own[send]
                rank = _column(rb, "rank")
                p = first[own] + pos[at]
                left, right = np.minimum(pos[at], m.left), np.minimum(first[own + 1] - p, m.window)
                gram = K.Ranges(symbols)(p, p + m.gram)
                b = (gram % K.U64(n_buckets)).astype(np.int32)
                for part in np.split(np.argsort(b, kind="stable"), np.flatnonzero(np.diff(np.sort(b))) + 1):
                    look = p[part][:, None] + np.arange(-m.left, m.window)
                    mask = (look >= (p - left)[part][:, None]) & (look < (p + right)[part][:, None])
                    put(
                        1, 2, bucket=[int(b[part[0]])], text=[_wide(m, symbols, data, look, mask).tobytes()], a=[K.planes(gram[part], 8)],
                        b=[K.planes(keys[own[part]].astype(K.U64), 8) + K.planes(rank[own[part]].astype(K.U64), m.rank_bytes)],
                        c=[K.planes(pos[at[part]], 5) + K.planes(left[part], 1) + K.planes(right[part], 1) + K.planes(state[at[part]], 1)],
                    )
        return pa.Table.from_batches(out, schema)

    return meet


def _wide(m: Method, symbols: np.ndarray, data: np.ndarray, look: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Contexts, row by row, each symbol cut to the method's bytes; zeros outside the document."""
    if m.symbol_bytes == 1:
        return np.where(mask, data[np.clip(look, 0, len(data) - 1)], 0).astype(np.uint8)
    found = np.where(mask, symbols[np.clip(look, 0, len(symbols) - 1)], 0).astype("<u8")
    return np.ascontiguousarray(found.view(np.uint8).reshape(*look.shape, 8)[:, :, 8 - m.symbol_bytes :])


def _compare(m: Method, groups: int):
    width = (m.left + m.window) * m.symbol_bytes

    def compare(tab: pa.Table) -> pa.Table:
        cols, views = [[] for _ in range(7)], []
        # contexts stay where Arrow has them; only the grams at hand are copied
        for rb in tab.select(["text", "a", "b", "c"]).to_batches():
            for i in range(rb.num_rows):
                gram = K.unplanes(rb.column(1)[i].as_py(), 8)
                b, c, n = rb.column(2)[i].as_py(), rb.column(3)[i].as_py(), len(gram)
                rank = K.unplanes(b[8 * n :], m.rank_bytes) if m.rank_bytes else np.zeros(n, K.U64)
                small = [np.frombuffer(c[k * n : (k + 1) * n], np.uint8) for k in (5, 6, 7)]
                for col, v in zip(cols, (gram, K.unplanes(b[: 8 * n], 8).astype(np.int64), rank.astype(np.int64), K.unplanes(c[: 5 * n], 5).astype(np.int64), *small)):
                    col.append(v)
                views.append(np.frombuffer(rb.column(0)[i].as_buffer(), np.uint8).reshape(n, width))
        gram, key, rank, pos, left, right, state = (np.concatenate(x) for x in cols)
        base = np.concatenate([[0], np.cumsum([len(v) for v in views])])
        order = np.argsort(gram, kind="stable")
        sizes = np.diff(np.concatenate([[0], np.flatnonzero(np.diff(gram[order])) + 1, [len(order)]]))
        # whole grams at a time, some ten thousand contexts
        block = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // 16_384
        found_at, found = [], []
        for part in np.split(order, np.cumsum(sizes)[:-1][np.diff(block) > 0]):
            part = np.sort(part)
            view = np.searchsorted(base, part, "right") - 1
            wide = np.empty((len(part), width), np.uint8)
            for v in np.unique(view):
                rows = np.flatnonzero(view == v)
                wide[rows] = views[v][part[rows] - base[v]]
            hit = m.compare(gram[part], rank[part], wide, left[part].astype(np.int64), right[part].astype(np.int64))
            some = hit.any(axis=1) & (state[part] & NEED > 0)
            found_at.append(part[some])
            found.append((hit[some].astype(K.U64) << np.arange(hit.shape[1], dtype=K.U64)).sum(axis=1, dtype=K.U64))
        at, mask = np.concatenate(found_at), np.concatenate(found)
        return _replies(key[at], groups, pos=(pos[at], 5), mask=(mask, 4))

    return compare


def _finish(m: Method, schema: pa.Schema, carry: list[str]):
    def finish(docs: pa.Table, replies: pa.Table) -> pa.Table:
        key, pos, mask = _gather(replies, pos=5, mask=4)
        order = np.argsort(key, kind="stable")
        key, pos, mask = key[order], pos[order], mask[order]
        out = []
        for rb, data, offs in K.slices(docs.to_batches(), "text"):
            _, first, more = m.tokens(data, offs)
            at, own = _entries(_column(rb, "key"), key)
            los, owns = [], []
            for o in range(m.left + 1):
                bit = (mask[at] >> o) & 1 > 0
                los.append(pos[at[bit]] - o)
                owns.append(own[bit])
            lo, who = np.concatenate(los), np.concatenate(owns)
            hi = lo + m.window
            a = [K.unplanes(x, 5).astype(np.int64) for x in rb.column(rb.schema.get_field_index("a")).to_pylist()]
            b = [K.unplanes(x, 5).astype(np.int64) for x in rb.column(rb.schema.get_field_index("b")).to_pylist()]
            who = np.concatenate([who, np.repeat(np.arange(len(a)), [len(x) for x in a])])
            covered = _cover(first, who, np.concatenate([lo, *a]), np.concatenate([hi, *b]))
            cols = {k: pa.array(list(v), schema.field(k).type) for k, v in m.result(data, offs, more, first, covered).items()}
            cols |= {c: rb.column(rb.schema.get_field_index(c)).cast(schema.field(c).type) for c in carry}
            out.append(pa.RecordBatch.from_arrays([cols[f.name] for f in schema], schema=schema))
        return pa.Table.from_batches(out, schema)

    return finish


def repeated(docs: DataFrame, m: Method, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``m.columns`` and the columns named in ``carry`` (strings) for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    n = buckets(docs, text_col)
    groups = n | 1
    kept = [f"carried_{i}" for i in range(len(carry))]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), *[docs[c].cast("string").alias(k) for c, k in zip(carry, kept)])
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    rows = rows.select(key.alias("key"), F.coalesce("doc_id", F.lit(NO_ID)).alias("rank"), "*")
    anchors = rows.select("key", "rank", "text").mapInArrow(_scan(m, n), _ANCHORS)
    states = stored(anchors.groupBy("bucket").applyInArrow(_judge(m, groups), "grp int,keys binary,pos binary,state binary"), m.name + "-states")
    del anchors  # what holds a plan holds its shuffle files
    release(spark)
    borne = ["doc_id", *kept]
    tail = "doc_id long" + "".join(f",{k} string" for k in kept)
    ddl = f"kind int,key long,bucket int,text binary,a binary,b binary,c binary,{m.columns},{tail}"
    left = rows.withColumn("grp", group_column(F.col("key"), groups)).groupBy("grp")
    met = stored(left.cogroup(states.groupBy("grp")).applyInArrow(_meet(m, n, K.arrow_schema(ddl), borne), ddl), m.name + "-met")
    discard(states)
    release(spark)
    found = met.where("kind = 2").select("bucket", "text", "a", "b", "c").groupBy("bucket").applyInArrow(_compare(m, groups), "grp int,keys binary,pos binary,mask binary")
    end = f"{m.columns},{tail}"
    held = met.where("kind = 1").select("key", "text", "a", "b", *borne).withColumn("grp", group_column(F.col("key"), groups)).groupBy("grp")
    late = held.cogroup(found.groupBy("grp")).applyInArrow(_finish(m, K.arrow_schema(end), borne), end)
    names = [x.split()[0] for x in m.columns.split(",")]
    both = met.where("kind = 0").select(*names, *borne).unionByName(late)
    return both.select("doc_id", *names, *[F.col(k).alias(c) for c, k in zip(carry, kept)])
