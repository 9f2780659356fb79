"""Approximate nearest neighbours by several shifted Hilbert orderings.

Unit vectors are projected at random to ``DIMS`` dimensions and shifted, differently for each curve; Hilbert keys put
them in an order that Spark range-partitions into blocks.  A query is compared with the blocks of its own key's
neighbourhood, ``reach`` blocks to either side on every curve; the best of each block are merged and
ranked again by exact cosines.

``reach`` is measured, not assumed: a bounded sample of queries (``SAMPLE``) is searched in all blocks, and the reach is
the least whose recall on that sample is ``TARGET``.  Where vectors have close neighbours that is a block or two; where
they have no structure (independent directions) no ordering helps and the reach grows towards all blocks, which is
then a search of the query set against all rows in blocks.

Vectors are scaled by a power of two first, which changes no bit of a cosine and keeps tiny and huge components in range.
Equal vectors then are one candidate with its ``k + 1`` smallest ids (``row_number`` with Spark's partial group limit), so a
vector that a third of all rows share costs no more than another and its ties come out exactly.  Other vectors of one
direction are told apart by their exact cosines and ids before a block's best are chosen.

Defined cases: vectors that are null, empty, zero or have a null, NaN or infinite component take no part, as query or
candidate; vectors of another length than the query's are no candidates for it; with fewer than ``k`` candidates a query
returns all; ids that repeat are separate candidates but a query never returns its own id; a null id takes no part;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernel as K
from .storage import small_batches, stored

CURVES = 4
DIMS = 8
BITS = 7
SAMPLE = 192
TARGET = 0.97
BLOCK_ROWS = 8192
MIN_BLOCKS = 16
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows), by Gray-code transposition over bit planes."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(len(t), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Keys on one curve of vectors of one length."""
    n = vectors.shape[1]
    rng = np.random.default_rng([SEED, curve, n])
    axes = np.linalg.qr(rng.standard_normal((n, min(DIMS, n))))[0]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    # a projected coordinate of a random direction has deviation 1 / sqrt(n)
    at = unit @ axes * np.sqrt(n) / 6 + 0.5 + (rng.random(axes.shape[1]) - 0.5) / 4
    return hilbert_keys(np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False) if len(col) else np.zeros(0)
    return np.asarray(flat, np.float64).reshape(len(col), dim)


def _by_dim(tab):
    dims = np.asarray(tab.column("dim"))
    for d in np.unique(dims):
        yield int(d), np.flatnonzero(dims == d)


def _with_keys(batches):
    for rb in batches:
        tab = pa.Table.from_batches([rb])
        for dim, at in _by_dim(tab):
            part = tab.take(pa.array(at))
            v = _matrix(part["v"].combine_chunks(), dim)
            for curve in range(CURVES):
                cols = [pa.array(np.full(len(at), curve, np.int32)), pa.array(_keys(v, curve)), *(part[c].combine_chunks() for c in ("dim", "v", "ids", "query"))]
                yield from pa.Table.from_arrays(cols, names=["curve", "key", "dim", "v", "ids", "query"]).to_batches()


def _search(k: int):
    """Best candidates of one block for its queries: (query id, candidate ids and vector)."""
    names = ["query_id", "qv", "ids", "v"]

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
        schema = pa.schema(list(zip(names, kinds)))
        out = []
        for dim, at in _by_dim(block):
            mine = np.flatnonzero(np.asarray(queries["dim"]) == dim)
            if not len(mine):
                continue
            part = block.take(pa.array(at))
            v = _matrix(part["v"].combine_chunks(), dim)
            v_unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            first = np.array([x[0] for x in part["ids"].to_pylist()])
            ask = queries.take(pa.array(mine))
            # k + 1 candidates and the query's own vector suffice
            most = min(k + 2, len(v))
            for a in range(0, len(mine), 512):
                some = ask.slice(a, 512).combine_chunks()
                q = _matrix(some["v"].combine_chunks(), dim)
                s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ v_unit.T
                best = np.argpartition(-s, most - 1, axis=1)[:, :most] if most < len(v) else np.tile(np.arange(len(v)), (len(q), 1))
                if most < len(v):
                    last = np.take_along_axis(s, best, axis=1).min(axis=1)
                    for i in np.flatnonzero((s >= last[:, None] - 1e-9).sum(axis=1) > most):
                        tied = np.flatnonzero(s[i] >= last[i] - 1e-9)
                        exact = _cosines(q[i], v[tied])
                        best[i] = tied[np.lexsort((first[tied], -exact))[:most]]
                rows, cols = pa.array(np.repeat(np.arange(len(q)), best.shape[1])), pa.array(best.reshape(-1))
                found = [some["vec_id"].take(rows), some["v"].take(rows), part["ids"].take(cols), part["v"].take(cols)]
                out += pa.Table.from_arrays(found, names=names).cast(schema).to_batches()
        return pa.Table.from_batches(out, schema)

    return run


def _cosines(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector with each row, each from its own two vectors alone."""
    return (a * rows).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def _exact(batches):
    """Cosines in double precision, each from its own two vectors alone."""
    schema = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
    for rb in batches:
        scores = []
        for q, v in zip(rb.column(1).to_pylist(), rb.column(3).to_pylist()):
            a, b = np.array(q), np.array(v)
            scores.append(float(_cosines(a, b[None, :])[0]))
        yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(2), pa.array(scores, pa.float64())], schema=schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    scored = found.mapInArrow(_exact, "query_id long,ids array<long>,score double")
    pairs = scored.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_FOUND = "query_id long,qv array<double>,ids array<long>,v array<double>"


def nearest(vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col("v")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    top = F.array_max(F.transform(v, F.abs))
    rows = rows.where(finite).where(top > 0)
    # two factors, since one alone may be out of range
    half = F.pow(F.lit(2.0), F.floor(-F.log2(top) / 2))
    rows = rows.withColumn("half", half).select("vec_id", F.transform("v", lambda x: x * F.col("half") * F.col("half")).alias("v"))
    rank = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    # each task passes on at most k + 1 rows of a vector, and only those are sorted
    few = rows.withColumn("r", rank).where(F.col("r") <= k + 1)
    distinct = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = stored(distinct.select(F.size("v").alias("dim"), "v", "ids"), "ann-vectors")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.size("v").alias("dim"))
    n = distinct.count()
    blocks = max(MIN_BLOCKS, -(-n // BLOCK_ROWS))
    keyed = distinct.withColumn("query", F.lit(False)).mapInArrow(_with_keys, "curve int,key long,dim int,v array<double>,ids array<long>,query boolean")
    placed = keyed.repartitionByRange(CURVES * blocks, "curve", "dim", "key").withColumn("block", F.spark_partition_id())
    placed = stored(placed.select("block", "curve", "key", "dim", "v", "ids"), "ann-blocks")
    where_is = placed.select("v", "curve", "block")
    ends = {r["curve"]: (r["a"], r["b"]) for r in placed.groupBy("curve").agg(F.min("block").alias("a"), F.max("block").alias("b")).collect()}
    if not ends:
        return spark.createDataFrame([], "query_id long,rank int,vec_id long,score double")
    # queries with the block of their own vector on each curve
    asked = queries.join(where_is, "v").select("vec_id", "v", "dim", "curve", F.col("block").alias("home"))
    asked = stored(asked, "ann-queries")

    def searched(which: DataFrame, lo, hi) -> DataFrame:
        sent = which.select("vec_id", "v", "dim", F.explode(F.sequence(lo, hi)).alias("block"))
        return sent.groupBy("block").cogroup(placed.select("block", "dim", "v", "ids").groupBy("block")).applyInArrow(_search(k), _FOUND)

    low = F.element_at(F.create_map(*[F.lit(x) for c, (a, b) in ends.items() for x in (c, a)]), F.col("curve"))
    high = F.element_at(F.create_map(*[F.lit(x) for c, (a, b) in ends.items() for x in (c, b)]), F.col("curve"))
    sample = asked.where("curve = 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    truth = _ranked(searched(sample, low, high), k).join(rows.select(F.col("vec_id"), F.col("v").alias("nv")), "vec_id")
    truth = truth.join(where_is.withColumnRenamed("v", "nv"), "nv").join(asked.select(F.col("vec_id").alias("query_id"), "curve", "home"), ["query_id", "curve"])
    apart = truth.groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("block") - F.col("home"))).alias("apart"))
    steps = sorted((int(r["apart"]), r["count"]) for r in apart.groupBy("apart").count().collect())  # at most one row a block
    total, seen, reach = sum(n for _, n in steps), 0, 0
    for step, n_step in steps:
        if seen >= TARGET * total:
            break
        reach, seen = step, seen + n_step
    found = searched(asked, F.greatest(F.col("home") - reach, low), F.least(F.col("home") + reach, high))
    return _ranked(found, k)
