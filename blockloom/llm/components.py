"""Connected components of an edge table, by alternating star contraction.

Each round sends every node's larger neighbours to its least neighbour (large star), then its smaller ones (small
star).  Edges only move towards smaller ids, so after some logarithmic number of rounds each node points at the least of
its component.  Edges stay in tables; every round is written to the shared folder.

Each partition first contracts its own edges.  What is left of a graph of at most ``ONE_TASK`` edges is contracted by one task
instead of in rounds: the same components, and a fixed bound on what that task holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .storage import stored


ONE_TASK = 500_000


def _contract(batches):
    """Within a partition, edges to the least node of each local component (union-find): same components, no more
    edges than nodes."""
    parts = [(np.asarray(rb.column(0)), np.asarray(rb.column(1))) for rb in batches if rb.num_rows]
    if not parts:
        return
    a, b = (np.concatenate(x) for x in zip(*parts))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    top = list(range(len(nodes)))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            top[max(x, y)] = min(x, y)
    low = np.array([root(x) for x in range(len(nodes))])
    pick = np.flatnonzero(low != np.arange(len(nodes)))
    yield K.table(K.arrow_schema("u long,v long"), u=nodes[pick], v=nodes[low[pick]])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node."""
    e = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).where("u <> v")
    e = stored(e.mapInArrow(_contract, "u long,v long").distinct(), "edges")  # u > v from here on

    def labelled(e: DataFrame) -> DataFrame:
        tops = e.select(F.col("v").alias("node")).distinct()
        return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops.select("node", F.col("node").alias("component")))

    if one_task and e.count() <= one_task:
        return labelled(stored(e.coalesce(1).mapInArrow(_contract, "u long,v long"), "edges"))

    def star(pairs: DataFrame) -> DataFrame:
        """From (centre, neighbour): neighbour or centre to the least of the neighbourhood."""
        least = pairs.groupBy("c").agg(F.min("n").alias("m"))
        return pairs.join(least, "c")

    before = None
    while True:
        both = e.select(F.col("u").alias("c"), F.col("v").alias("n")).unionByName(e.select(F.col("v").alias("c"), F.col("u").alias("n")))
        large = star(both).where("n > c").select(F.col("n").alias("u"), F.least("c", "m").alias("v")).distinct()
        down = star(large.select(F.col("u").alias("c"), F.col("v").alias("n")))
        small = down.where("n <> m").select(F.col("n").alias("u"), F.col("m").alias("v")).unionByName(down.select(F.col("c").alias("u"), F.col("m").alias("v")))
        e = stored(small.where("u > v").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return labelled(e)
