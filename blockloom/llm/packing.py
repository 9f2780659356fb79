"""Best-fit packing into bins of several permitted lengths.

Documents are cut into pieces of at most the largest capacity; every token goes into exactly one piece.  Pieces
are dealt to shards of bounded size by hash, and each shard is packed by itself:

1. pieces in falling length go to the open bin with the least room that suffices (best fit);
2. where none suffices, a bin opens at the capacity with the least cost per token that it can be expected to
   hold: ``cost(c) = fixed + c``, spread over the piece and over what later, shorter pieces of the shard can
   fill;
3. at the end each bin shrinks to the smallest permitted capacity that holds its contents.

Step 1 uses one queue of bins for each amount of room and a bit set of the rooms that have bins, so a piece
costs a constant number of integer operations.  The shards grow in number, not in size, with the corpus.

Shards are dealt by row, not by id, so ids that repeat or are null never crowd one.

Defined cases: a null or negative length counts as zero, and a document without tokens is one piece of length
zero with no bin (``bin_id`` null); equal lengths go by id (nulls last) and piece; repeated rows are packed each on
their own; a null id is packed as any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import small_batches, stored

CAPACITIES = (512, 1024, 2048, 4096)
#: Tokens' worth of overhead for one more bin.
FIXED_COST = 16
#: Tokens for one shard: a few MB of pieces, and waste at its end far under one per cent.
SHARD_TOKENS = 1_000_000
_DDL = "doc_id long,piece int,start long,n_tokens long,bin_id string,capacity int,offset int"


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, fixed: int = FIXED_COST) -> tuple[list[int], list[int], list[int]]:
    """``(bin of each piece, offset in it, capacity of each bin)``; lengths must be in falling order and within
    the largest capacity."""
    caps = sorted(capacities)
    top = caps[-1]
    open_bins: list[deque] = [deque() for _ in range(top + 1)]
    rooms = 0
    used: list[int] = []
    where, offset, size = [], [], []
    left = sum(lengths)
    for n in lengths:
        left -= n
        fits = rooms >> n
        if n and fits:
            room = n + ((fits & -fits).bit_length() - 1)
            b = open_bins[room].popleft()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            # a bin's cost per token held: later pieces are no longer than this one, so what is left of
            # them fills it; with little left a smaller bin is cheaper
            room = min((c for c in caps if c >= n), key=lambda c: ((fixed + c) / max(1, min(c, n + left)), c))
            b = len(used)
            used.append(0)
            size.append(room)
        where.append(b)
        offset.append(used[b])
        used[b] += n
        room -= n
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return where, offset, [caps[bisect_left(caps, u)] for u in used]


def _pack_shard(capacities: tuple[int, ...]):
    schema = K.arrow_schema(_DDL)

    def run(key, tab: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        ids = tab["doc_id"].fill_null(0).to_numpy()
        n = tab["n_tokens"].to_numpy()
        piece, start = tab["piece"].to_numpy(), tab["start"].to_numpy()
        row, none = tab["row"].to_numpy(), np.asarray(tab["doc_id"].is_null())
        order = np.lexsort((start, row, ids, none, -n))
        where, offset, caps = pack(n[order].tolist(), capacities)
        caps_of = np.array(caps, np.int32)[where] if len(where) else np.zeros(0, np.int32)
        return K.table(
            schema, doc_id=tab["doc_id"].take(pa.array(order)).combine_chunks(), piece=piece[order], start=start[order], n_tokens=n[order],
            bin_id=[f"{shard}-{b}" for b in where], capacity=caps_of, offset=np.array(offset, np.int32),
        )

    return lambda key, tab: pa.Table.from_batches([run(key, tab)])


def packing(docs: DataFrame, length, *, capacities: tuple[int, ...] = CAPACITIES, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id") -> DataFrame:
    """Pieces of every document with their bin, its final capacity and the place in it.

    ``length``: a Column with the number of tokens of a row.
    """
    small_batches(docs.sparkSession)
    top = max(capacities)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("total"))
    # lengths may be costly, and a row's number must stay what it is: both are stored once, without texts
    base = stored(base.withColumn("row", F.monotonically_increasing_id()), "lengths")
    total = base.agg(F.sum("total")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_tokens))
    starts = F.when(F.col("total") > 0, F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(top).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    pieces = base.select("doc_id", "row", "total", F.posexplode(starts).alias("piece", "start"))
    pieces = pieces.select("doc_id", "row", "piece", "start", F.least(F.col("total") - F.col("start"), F.lit(top).cast("long")).alias("n_tokens"))
    full = pieces.where("n_tokens > 0").withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))
    packed = full.groupBy("shard").applyInArrow(_pack_shard(tuple(capacities)), _DDL)
    empty = pieces.where("n_tokens = 0").select("doc_id", "piece", "start", "n_tokens", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("int").alias("offset"))
    return packed.unionByName(empty)


@functools.lru_cache(maxsize=1)
def _tokenizer(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def with_token_counts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every row: how many ids a SentencePiece model gives its whole text.

    The counts equal those of ``sentencepieces.encode`` for the same model, so ``start`` and ``n_tokens`` of a piece are a
    slice of the ids found there.  The counting is left to the library, which needs a third of the CPU time."""
    small_batches(docs.sparkSession)
    ddl = "doc_id long,n_tokens long"

    def run(batches):
        sp, schema = _tokenizer(model), K.arrow_schema(ddl)
        for rb, data, offs in K.slices(batches, "text"):
            raw = data.tobytes()
            ids = sp.encode([raw[a:b].decode() for a, b in zip(offs[:-1], offs[1:])], num_threads=1)
            yield K.table(schema, doc_id=rb.column(0), n_tokens=[len(x) for x in ids])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, ddl)
