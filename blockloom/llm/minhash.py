"""MinHash near-duplicates by an LSH forest.

A document is the set of its distinct shingles.  Equal sets are one node of the graph, named by a hash of the set, so ids
that repeat or are null never confuse two texts.  Each node has ``PERMS`` min-hashes; a tree of the forest reads them in its
own order, and in sorted signature order near-duplicates are neighbours with a long common prefix.

1. Trees are cut into regions by the first ``DEPTH`` min-hashes.
2. Neighbours in sorted order of a region are candidates, if their sizes and the agreement of their signatures allow the
   threshold, and so are members with a middle: the member that holds most of the region's most frequent labels.  What
   does not agree with a middle is searched for its own, one label deeper where the region falls apart (adaptive depth).
   Each document keeps the candidate with the most votes and the one with the best agreement; these links are
   confirmed on full sets, and components formed.
3. The regions are read again, whole: in a region that still holds several components, members that might be linked
   across components are tied to one of them, its hub, and form its family.  Members of a family that fits in a block
   send a sketch to it, and those whose sketches allow a link form families anew, one for each document, so that a full
   set is sent once however many hubs a document has.  Links that remain are found exactly in
   each family.  One that fits in a block is compared there, all with all.  In larger ones, see ``_apart``, members are
   compared by what sets them apart from the family's centre, its majority set, and meet only where they share a rare
   difference.  So a crowd that just misses the threshold costs little, and no pair is made for two documents that are
   known to hang together.

Links are confirmed in blocks: candidates form families, families are dealt to blocks of some hundred kilobytes, and
a full set travels once to each bucket of pairs of blocks that has a candidate pair of it, not once for each pair.
Tasks take turns in rounds, so that what is under way at once is a bounded share of all sets, however many are wanted.

All links that join what shares a region are thus found; two documents at the threshold share no region in any tree
with a probability of 1e-5 at most, whatever the size of the regions; sketches miss a link with less than 1e-6.

Full sets are 48-bit hashes of shingles.  They go from the texts straight to the tasks of a round and are not stored, but
for families of several blocks.

Defined cases: null text or no words: an empty set, linked with nothing; fewer words than a shingle: the whole
sequence is one shingle; repeated rows and equal texts are one component; rows that share an id and differ in text
each follow their own text; a null id is a document of its own, kept, with a null component; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .storage import discard, release, small_batches, stored

PERMS = 64
TREES = 16
DEPTH = 3
#: Labels of a region's members: DEPTH leading ones of 16 bits, then LABELS of 8 bits for deeper levels and agreement.
LABELS = 56
#: Pairs that are compared at once.
AT_ONCE = 4 << 20
#: Bytes of full sets in one block of a family, on average.
BLOCK_BYTES = 512 << 10
#: Members of one block of a family of a hub, and bytes of their full sets, on average.
HUB_MEMBERS = 1024
HUB_BYTES = 32 << 20
#: Candidate pairs between two blocks of a family, on average.
BLOCK_PAIRS = 1 << 16
#: Bytes of full sets that one task holds, on average, if every set were needed.
BUCKET_BYTES = 8 << 20
#: Rows of two numbers that are broadcast at most (4 MB).
BROADCAST_ROWS = 1 << 18
#: Bytes of full sets or sketches in the exchange of a round: at most a quarter of all sets, or these.
ROUND_BYTES = 64 << 20
#: Bytes of a shingle's hash in a full set.
WIDTH = 6
#: Least shingle hashes (their 32 leading bits) in a sketch; a set of fewer shingles is its own sketch.
SKETCH = 512
_A = K.mix(np.arange(PERMS, dtype=K.U64) + K.U64(0xA11CE)) | K.U64(1)
_B = K.mix(np.arange(PERMS, dtype=K.U64) + K.U64(0xB0B))
_ORDER = np.stack([np.roll(np.arange(PERMS), -4 * t)[: DEPTH + LABELS] for t in range(TREES)])
_SIG = "doc_id long,n_shingles long,node long,signature binary"
_SETS = "of long,node long,shingles binary"


def shingles(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, in order of document and hash, with their documents and counts."""
    w = K.Words(K.LOWER[data], offs)
    docs = len(offs) - 1
    if not len(w.start):
        return np.zeros(0, K.U64), np.zeros(0, np.int64), np.zeros(docs, np.int64)
    ranges = K.Ranges(w.hashes(K.LOWER[data]))
    at = np.arange(len(w.start))
    at = at[at + size <= w.first[w.doc + 1]]
    short = np.flatnonzero((w.n > 0) & (w.n < size))
    h = np.concatenate([ranges(at, at + size), ranges(w.first[short], w.first[short] + w.n[short])])
    doc = np.concatenate([w.doc[at], short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    h, doc = h[new], doc[new]
    return h, doc, np.bincount(doc, minlength=docs).astype(np.int64)


def signatures(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Min-hashes (their 16 leading bits) of sets that lie one after another."""
    out = np.zeros((len(n), PERMS), np.uint16)
    some = np.flatnonzero(n)
    ends = np.cumsum(n[some])
    starts = ends - n[some]
    i = 0
    while i < len(some):
        # some thousands of shingles at a time stay in the cache
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + 8192, "right")))
        part = h[starts[i] : ends[j - 1]]
        at = starts[i:j] - starts[i]
        for p in range(PERMS):
            out[some[i:j], p] = np.minimum.reduceat(((part * _A[p] + _B[p]) >> K.U64(48)).astype(np.uint16), at)
        i = j
    return out


def _nodes(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    sums = np.concatenate([[K.U64(0)], np.cumsum(K.mix(h))])
    ends = np.cumsum(n)
    return K.mix((sums[ends] - sums[ends - n]) ^ K.mix(n.astype(K.U64))).view(np.int64)


def _sign(size: int):
    def run(batches):
        schema = K.arrow_schema(_SIG)
        for rb, data, offs in K.slices(batches, "text"):
            h, _, n = shingles(data, offs, size)
            sig = signatures(h, n)
            yield K.table(schema, doc_id=rb.column(0), n_shingles=n, node=_nodes(h, n), signature=[s.tobytes() for s in sig])

    return run


def _sets(size: int):
    """Full sets of rows whose text has the node that is wanted, one for each task that they are for; once in a task of
    this stage."""

    def run(batches):
        schema, seen = K.arrow_schema(_SETS), set()
        for rb, data, offs in K.slices(batches, "text"):
            h, _, n = shingles(data, offs, size)
            ends = np.cumsum(n)
            short = h >> K.U64(64 - 8 * WIDTH)
            want, of = (rb.column(rb.schema.get_field_index(c)).to_pylist() for c in ("want", "of"))
            for node, w, tasks, e, c in zip(_nodes(h, n).tolist(), want, of, ends, n):
                if node == w and node not in seen:
                    seen.add(node)
                    packed = K.planes(np.unique(short[e - c : e]), WIDTH)
                    for at in range(0, len(tasks), 64):
                        some = tasks[at : at + 64]
                        yield K.table(schema, of=some, node=[node] * len(some), shingles=[packed] * len(some))

    return run


def _sketches(size: int):
    """Sketches of rows whose text has the node that is wanted: its least hashes, which come first; once in a task."""

    def run(batches):
        schema, seen = K.arrow_schema("node long,n long,sketch binary"), set()
        for rb, data, offs in K.slices(batches, "text"):
            h, _, n = shingles(data, offs, size)
            out = []
            for node, want, at, c in zip(_nodes(h, n).tolist(), rb.column(rb.schema.get_field_index("want")).to_pylist(), np.cumsum(n) - n, n):
                if node == want and node not in seen:
                    seen.add(node)
                    out.append((node, c, K.planes(h[at : at + min(c, SKETCH)] >> K.U64(32), 4)))
            if out:
                nodes, sizes, sketches = zip(*out)
                yield K.table(schema, node=nodes, n=sizes, sketch=sketches)

    return run


def _forest(n_buckets: int):
    """Members of regions, packed by bucket: key, node, size, component, labels."""
    schema = K.arrow_schema("bucket int,members binary")
    kind = np.dtype([("key", "<u8"), ("id", "<i8"), ("n", "<i4"), ("component", "<i8"), ("labels", "u1", LABELS)])

    def run(batches):
        held, size = [], 0

        def flush():
            m = np.concatenate(held)
            b = (m["key"] % n_buckets).astype(np.int32)
            order = np.argsort(b, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
                yield K.table(schema, bucket=[int(b[part[0]])], members=[m[part].tobytes()])

        for rb in batches:
            if not rb.num_rows:
                continue
            sig = np.frombuffer(b"".join(rb.column(2).to_pylist()), np.uint16).reshape(-1, PERMS)
            ids, n, comp = (np.asarray(rb.column(i)) for i in (0, 1, 3))
            for t in range(TREES):
                m = np.zeros(len(ids), kind)
                lead = sig[:, _ORDER[t, :DEPTH]].astype(K.U64)
                key = np.full(len(ids), t, K.U64)
                for d in range(DEPTH):
                    key = K.mix(key * K.U64(3) ^ lead[:, d])
                m["key"], m["id"], m["n"], m["component"] = key, ids, n, comp
                m["labels"] = (sig[:, _ORDER[t, DEPTH:]] >> np.uint16(8)).astype(np.uint8)
                held.append(m)
                size += len(ids)
            if size >= 400_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run, kind


class Rules:
    """Which pairs may reach the threshold, by sizes and by agreement of labels."""

    def __init__(self, percent: int):
        self.percent = percent
        s = percent / 100
        # agreement at the threshold is binomial; four deviations below it
        self.least = int(LABELS * s - 4 * np.sqrt(LABELS * s * (1 - s)))
        #: A middle that agrees so much with a member speaks for it.
        self.close = int(LABELS * s)

    def sizes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    def likely(self, both, union, cut):
        """Whether samples of a union with ``both`` shared allow the threshold: five deviations below it, if ``cut``."""
        s = self.percent / 100
        return both >= s * union - np.where(cut, 5 * np.sqrt(s * (1 - s) * union), 0)

    def links(self, both, a, b):
        """The exact decision: sets of ``a`` and ``b`` elements with ``both`` in common."""
        return 100 * both >= self.percent * (a + b - both)


def _middle(labels: np.ndarray) -> int:
    """The member (row) that holds most of the labels that are the most frequent at their place."""
    places = np.arange(labels.shape[1]) * 256
    seen = np.bincount((labels + places).ravel(), minlength=256 * labels.shape[1]).reshape(-1, 256)
    return int((labels == seen.argmax(axis=1)).sum(axis=1).argmax())


def _middles(r: np.ndarray, rules: Rules) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Middles of a region with the members that agree, and how much.  What agrees less than ``close`` goes on to find
    a middle of its own, one label deeper if that is most of the region."""
    todo = [(np.arange(len(r)), 0)]
    while todo:
        part, depth = todo.pop()
        labels = r["labels"][part]
        at = _middle(labels)
        agree = (labels == labels[at]).sum(axis=1)
        hit = (agree >= rules.least) & rules.sizes(r["n"][part], r["n"][part[at]])
        hit[at] = False
        yield int(part[at]), part[hit], agree[hit]
        rest = part[(agree < rules.close) & (np.arange(len(part)) != at)]
        if 2 * len(rest) <= len(part):
            todo += [(rest, depth)] if len(rest) > 1 else []
        elif depth < LABELS:
            label = r["labels"][rest, depth]
            sub = np.argsort(label, kind="stable")
            todo += [(rest[x], depth + 1) for x in np.split(sub, np.flatnonzero(np.diff(label[sub])) + 1) if len(x) > 1]


def _members(batches, kind: np.dtype) -> np.ndarray:
    """Members of regions of two or more."""
    parts = [np.frombuffer(x, kind) for rb in batches for x in rb.column(rb.schema.get_field_index("members")).to_pylist()]
    m = np.concatenate([np.zeros(0, kind), *parts])
    return m[K.duplicated(m["key"])]


_NEAR = "child long,parent long,agree int,votes int"


def _neighbours(kind: np.dtype, rules: Rules):
    """Candidates (child, parent): neighbours in sorted order, and members with a middle of their region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _members(batches, kind)
        if not len(m):
            return
        deep = np.ascontiguousarray(m["labels"]).view(">u8").astype(K.U64)
        m = m[np.lexsort((*(deep[:, i] for i in range(deep.shape[1] - 1, -1, -1)), m["key"]))]
        agree = (m["labels"][1:] == m["labels"][:-1]).sum(axis=1)
        ok = (m["key"][1:] == m["key"][:-1]) & (agree >= rules.least) & rules.sizes(m["n"][1:], m["n"][:-1]) & (m["id"][1:] != m["id"][:-1])
        a, b = m["id"][:-1][ok], m["id"][1:][ok]
        out = [np.stack([np.maximum(a, b), np.minimum(a, b), agree[ok], np.zeros(len(a), np.int64)])]
        start = np.flatnonzero(np.concatenate([[True], np.diff(m["key"]) != 0]))
        ends = np.append(start[1:], len(m))
        for x, y in zip(start[ends - start > 2], ends[ends - start > 2]):
            r = m[x:y]
            for mid, hit, w in _middles(r, rules):
                out.append(np.stack([r["id"][hit], np.full(len(hit), r["id"][mid]), w.astype(np.int64), np.ones(len(hit), np.int64)]))
        child, parent, w, votes = np.concatenate(out, axis=1)
        yield K.table(K.arrow_schema(_NEAR), child=child, parent=parent, agree=w.astype(np.int32), votes=votes.astype(np.int32))

    return run


def _agreement(labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Equal labels of some members with all; ``labels`` has a line for each label."""
    out = np.zeros((len(rows), labels.shape[1]), np.uint8)
    for line in labels:
        out += line[rows][:, None] == line[None, :]
    return out


def _hubs(kind: np.dtype, rules: Rules):
    """Ties (member, hub) in regions of several components.  Members that agree with the region's middle are tied to it;
    the others only if one of them might be linked with a member of another component, rows against rows in blocks."""

    schema = K.arrow_schema("node long,hub long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _members(batches, kind)
        if not len(m):
            return
        m = m[np.argsort(m["key"], kind="stable")]
        start = np.flatnonzero(np.concatenate([[True], np.diff(m["key"]) != 0]))
        ends = np.append(start[1:], len(m))
        mixed = np.minimum.reduceat(m["component"], start) != np.maximum.reduceat(m["component"], start)
        ties = []
        for x, y in zip(start[mixed], ends[mixed]):
            r = m[x:y]
            r = r[np.argsort(r["id"])]  # of equal middles the one with the least name, in every tree
            mid = _middle(r["labels"])
            near = ((r["labels"] == r["labels"][mid]).sum(axis=1) >= rules.least) & rules.sizes(r["n"], r["n"][mid])
            comp = r["component"]
            if comp[near].min() != comp[near].max():
                ties.append((r["id"][near], r["id"][mid]))
            others = np.flatnonzero(~near)
            if not len(others):
                continue
            labels = np.ascontiguousarray(r["labels"].T)
            tied = np.zeros(len(r), bool)
            step = max(1, AT_ONCE // len(r))
            for at in range(0, len(others), step):
                own = others[at : at + step]
                ok = (_agreement(labels, own) >= rules.least) & (comp[own][:, None] != comp[None, :]) & rules.sizes(r["n"][own][:, None], r["n"][None, :])
                tied[own] |= ok.any(axis=1)
                tied |= ok.any(axis=0)
            if tied.any():
                ties.append((r["id"][tied], r["id"][tied][_middle(r["labels"][tied])]))
        if ties:
            # one tie for each member and hub of this bucket
            both = np.unique(np.concatenate([np.stack([i, np.full(len(i), hub)], axis=1) for i, hub in ties]), axis=0)
            yield K.table(schema, node=both[:, 0], hub=both[:, 1])

    return run


def _confirm(rules: Rules):
    """Candidate pairs of one bucket that reach the threshold, from the sets of its documents."""

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        held = dict(zip(sets["node"].to_pylist(), (K.unplanes(x, WIDTH) for x in sets["shingles"].to_pylist())))
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        out = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
            ra, rb = root(a), root(b)
            if ra == rb:
                continue  # linked already: the pair changes nothing
            x, y = held[a], held[b]
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            if rules.links(int((y[np.minimum(at, len(y) - 1)] == x).sum()), len(x), len(y)):
                top[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Elements that each two of some sets share."""
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    own = np.flatnonzero(count > 1)
    at = np.searchsorted(own, element)
    both = np.zeros((len(sets), len(sets)), np.float32)
    held = np.flatnonzero(count[element] > 1)
    held = held[np.argsort(at[held], kind="stable")]
    cuts = np.searchsorted(at[held], np.arange(0, len(own) + 4096, 4096))
    for x, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        m = np.zeros((len(sets), 4096), np.float32)
        m[member[held[lo:hi]], at[held[lo:hi]] - 4096 * x] = 1
        both += m @ m.T
    return both.astype(np.int64)


def _alike(rules: Rules):
    """Edges that hold together members of a family whose sketches allow a link between components.

    Below the lesser of two sketches' last values both sets are known whole; what they hold there is a sample of their
    union, of ``SKETCH`` elements at least where one of them is cut.
    """

    def run(tab: pa.Table) -> pa.Table:
        of: dict[int, list] = {}
        for r in tab.select(["family", "node", "component", "n", "sketch"]).to_pylist():
            of.setdefault(r["family"], []).append((r["node"], r["component"], r["n"], K.unplanes(r["sketch"], 4).astype(np.int64)))
        out = []
        for rows in of.values():
            nodes, comp, n = (np.array(x) for x in list(zip(*rows))[:3])
            parts = [x for *_, x in rows]
            size = np.array([len(x) for x in parts])
            cut = n > SKETCH
            last = np.array([x[-1] if c else 1 << 32 for x, c in zip(parts, cut)])
            rank = np.stack([np.searchsorted(x, last, "right") for x in parts])
            both = _shared(parts)
            union = np.where(last[:, None] <= last[None, :], size[:, None] + rank.T, size[None, :] + rank) - both
            ok = rules.likely(both, union, cut[:, None] | cut[None, :]) & rules.sizes(n[:, None], n[None, :]) & (comp[:, None] != comp[None, :])
            left = ok.any(axis=1)
            while left.any():
                todo = [int(left.argmax())]
                left[todo] = False
                while todo:
                    x = todo.pop()
                    new = np.flatnonzero(ok[x] & left)
                    left[new] = False
                    out += [(nodes[x], nodes[y]) for y in new]
                    todo += new.tolist()
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _within(rules: Rules):
    """Links between components in families of one block each, every member against every other."""

    def run(tab: pa.Table) -> pa.Table:
        of: dict[int, dict] = {}
        for r in tab.select(["family", "node", "component", "shingles"]).to_pylist():
            of.setdefault(r["family"], {})[r["node"]] = (r["node"], r["component"], K.unplanes(r["shingles"], WIDTH))
        out = []
        for rows in (list(x.values()) for x in of.values()):
            n = np.array([len(x) for _, _, x in rows])
            comp = np.array([c for _, c, _ in rows])
            both = _shared([x for _, _, x in rows])
            i, j = np.nonzero(rules.links(both, n[:, None], n[None, :]) & (comp[:, None] < comp[None, :]))
            # one link for two components is enough
            _, one = np.unique(np.stack([comp[i], comp[j]]), axis=1, return_index=True)
            out += [(rows[a][0], rows[b][0]) for a, b in zip(i[one], j[one])]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _centres(tab: pa.Table) -> pa.Table:
    """For each family, the elements that more than half of one block of its members hold."""
    of: dict[int, list[np.ndarray]] = {}
    for r in tab.select(["family", "shingles"]).to_pylist():
        of.setdefault(r["family"], []).append(K.unplanes(r["shingles"], WIDTH))
    cores = []
    for parts in of.values():
        own, n = np.unique(np.concatenate(parts), return_counts=True)
        cores.append(K.planes(own[2 * n > len(parts)], WIDTH))
    return pa.table({"family": pa.array(list(of), pa.int64()), "core": pa.array(cores, pa.binary())})


_STANDING = "family long,node long,n long,excess long,least long"
_ELEMENTS = "family long,node long,element long"


def _apart(rules: Rules, elements: bool):
    """What sets the members of families apart from their centres.

    A centre c is any set.  With D(x) the elements that either x or c has, x and y do not share |D(x)| + |D(y)| - 2 |D(x) & D(y)|
    elements.  With P the threshold in per cent and E(x) = (100 + P) |D(x)| - (100 - P) |x| this gives, exactly: x and y are
    linked if and only if 2 (100 + P) |D(x) & D(y)| >= E(x) + E(y).

    Let r be the member with the least E, and let links with r be settled.  Of two members in different components then
    E(x) + E(y) > 0, since else both were linked with r; so they share a difference, and x shares at least
    (E(x) + m) / (2 (100 + P)) of them, m being the least E in other components.  Since |x| <= |c| + |D(x)| and no more than
    |D(x)| is shared, it is also (E(y) - (100 - P) |c|) / 200 or more.

    Two sets that share t elements share one within the first |D| - t + 1 of each, in one order for all; the order here is
    from rare to frequent in the family, and what occurs once in it can not be shared.
    """
    p = rules.percent

    def run(members: pa.Table, heads: pa.Table) -> pa.Table:
        cores = {r["block"]: K.unplanes(r["core"], WIDTH) for r in heads.select(["block", "core"]).to_pylist()}
        rows, seen = [], set()
        for rb in members.select(["block", "family", "node", "shingles"]).to_batches(1000):
            for r in rb.to_pylist():
                if (r["block"], r["node"]) in seen:
                    continue  # a set may come twice
                seen.add((r["block"], r["node"]))
                x, c = K.unplanes(r["shingles"], WIDTH), cores[r["block"]]
                d = np.setxor1d(x, c, assume_unique=True)
                if elements:
                    rows.append((np.full(len(d), r["family"]), np.full(len(d), r["node"]), d.astype(np.int64)))
                else:
                    rows.append((r["family"], r["node"], len(d), (100 + p) * len(d) - (100 - p) * len(x), (100 - p) * len(c)))
        schema = K.arrow_schema(_ELEMENTS if elements else _STANDING)
        if not rows:
            return schema.empty_table()
        cols = [np.concatenate(v) if elements else np.array(v, np.int64) for v in zip(*rows)]
        return pa.Table.from_batches([K.table(schema, **dict(zip(schema.names, cols)))])

    return run


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    ``size``: words in a shingle; ``percent``: the least similarity, in hundredths."""
    spark = docs.sparkSession
    small_batches(spark)
    rules = Rules(percent)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    signed = stored(rows.mapInArrow(_sign(size), _SIG), "minhash-signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    reps = full.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.min("signature").alias("signature"))
    reps = stored(reps, "minhash-sets")
    n, weight = reps.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(partitions, -(-n * TREES // 500_000))
    n_tasks = max(partitions, -(-weight * WIDTH // BUCKET_BYTES))
    forest, kind = _forest(n_buckets)

    def regions(labels: DataFrame | None, method, ddl: str) -> DataFrame:
        members = reps.select("node", F.col("n").cast("int"), "signature")
        if labels is not None:
            members = members.join(labels, "node", "left")
        comp = F.col("node") if labels is None else F.coalesce("component", "node")
        packed = members.select("node", "n", "signature", comp.alias("component")).mapInArrow(forest, "bucket int,members binary")
        # a task reads its buckets at once: grouping by bucket would sort them for nothing
        return packed.repartition(n_buckets, "bucket").select("members").mapInArrow(method, ddl)

    round_bytes = max(ROUND_BYTES, weight * WIDTH // 4)
    origin = reps.select("node", "n", F.col("rep").alias("doc_id"))

    def made(nodes: DataFrame, method, ddl: str, name: str) -> DataFrame:
        """What ``method`` makes of the texts of ``nodes``, which are distinct."""
        new = stored(nodes.join(origin.drop("n"), "node").withColumnRenamed("node", "want"), "minhash-wanted")
        # a few of the rows are wanted: a small table of them goes to the texts, a large one meets them in an exchange
        few = F.broadcast(new) if new.count() <= BROADCAST_ROWS else new
        out = stored(rows.join(few, "doc_id").select("text", *new.drop("doc_id").columns).mapInArrow(method, ddl), name)
        release(spark)
        discard(new)
        return out

    def sent(now: DataFrame) -> DataFrame:
        """Full sets from the texts to the tasks of a round that want them ``(of, node, doc_id)``."""
        to = now.groupBy("doc_id", F.col("node").alias("want")).agg(F.collect_set("of").alias("of"))
        return rows.join(F.broadcast(to), "doc_id").select("text", "want", "of").mapInArrow(_sets(size), _SETS)

    def blocks(family: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
        """Members of families ``(node, component)``, dealt to blocks by the weight of their sets and the number of pairs."""
        sized = family.join(reps.select("node", "n"), "node").groupBy("component").agg(F.ceil(WIDTH * F.sum("n") / (HUB_BYTES if pairs is None else BLOCK_BYTES)).cast("long").alias("k"), F.count(F.lit(1)).alias("m"))
        if pairs is None:
            sized = sized.select("component", F.greatest("k", F.ceil(F.col("m") / HUB_MEMBERS)).alias("k"))
        else:
            many = pairs.groupBy(F.col("a").alias("node")).count().join(family, "node").groupBy("component").agg(F.ceil(F.sqrt(F.sum("count") / BLOCK_PAIRS)).cast("long").alias("by_pairs"))
            sized = sized.join(many, "component").select("component", F.greatest("k", "by_pairs").alias("k"))
        salt = F.pmod(F.xxhash64("node"), F.col("k"))
        return family.join(sized, "component").select("node", "component", "k", salt.alias("salt"), F.xxhash64("component", salt).alias("block"))

    def rounds(wanted: DataFrame, task: str, n_bytes, method, name: str) -> DataFrame:
        """``method`` of what tasks want, in rounds of tasks: the wants of a round are broadcast, so that full sets go to
        their tasks at once, not by node before, and a round's exchange is gone when the next begins.  ``n_bytes``: what a
        want sends, from its ``n``."""
        count, held = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(n_bytes), F.lit(0))).first()
        k = max(1, -(-count // BROADCAST_ROWS), -(-held // round_bytes))
        out = []
        for i in range(k):
            turn = lambda c, i=i: F.pmod(F.xxhash64(c, F.lit(2)), F.lit(k)) == i
            out.append(stored(method(F.broadcast(wanted.where(turn(task))), turn), name))
            release(spark)
        return reduce(DataFrame.unionByName, out)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs.  Pairs that hang together are a family; a family is one block, or more by weight."""
        place = stored(blocks(components(pairs), pairs).select("node", "block"), "minhash-blocks")
        at = lambda c: place.select(F.col("node").alias(c), F.col("block").alias("block_" + c))
        task = F.pmod(F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")), F.lit(n_tasks))
        placed = stored(pairs.join(at("a"), "a").join(at("b"), "b").select("a", "b", task.alias("task")), "minhash-pairs")
        needed = stored(placed.select(F.col("task").alias("of"), F.explode(F.array("a", "b")).alias("node")).distinct().join(origin, "node"), "minhash-needed")
        out = rounds(needed, "of", WIDTH * F.col("n"), lambda now, turn: placed.where(turn("task")).groupBy("task").cogroup(sent(now).groupBy("of")).applyInArrow(_confirm(rules), "a long,b long"), "minhash-links")
        discard(place, placed, needed)
        return out

    near = stored(regions(None, _neighbours(kind, rules), _NEAR).groupBy("child", "parent").agg(F.max("agree").alias("agree"), F.sum("votes").alias("votes")), "minhash-candidates")
    release(spark)
    by = lambda *c: F.max_by("parent", F.struct(*c, "parent"))
    chosen = near.groupBy("child").agg(F.array_distinct(F.array(by("votes", "agree"), by("agree"))).alias("p")).select("child", F.explode("p").alias("parent"))
    parents = stored(chosen.select(F.least("child", "parent").alias("a"), F.greatest("child", "parent").alias("b")).distinct(), "minhash-parents")
    discard(near)
    links = confirmed(parents)
    discard(parents)
    release(spark)

    ties = stored(regions(components(links), _hubs(kind, rules), "node long,hub long").distinct(), "minhash-ties")
    release(spark)
    if not ties.isEmpty():
        tied = stored(blocks(ties.select("node", F.col("hub").alias("component"))).withColumnRenamed("component", "family"), "minhash-families")
        discard(ties)
        task = F.pmod(F.xxhash64("block"), F.lit(n_tasks)).alias("task")
        labels = components(links)

        def dealt(families: DataFrame) -> DataFrame:
            """Members of families of one block, with their component."""
            task = F.pmod(F.xxhash64("family"), F.lit(n_tasks)).alias("task")
            return families.where("k = 1").join(labels, "node", "left").join(origin, "node").select(task, "family", "node", F.coalesce("component", "node").alias("component"), "n", "doc_id")

        # a document has a family for each hub: sketches go to them, and full sets to the one family of what may link
        sketched = made(tied.where("k = 1").select("node").distinct(), _sketches(size), "node long,n long,sketch binary", "minhash-sketches")
        wanted = stored(dealt(tied), "minhash-dealt")
        alike = rounds(wanted, "task", 4 * F.least("n", F.lit(SKETCH)), lambda now, _: now.drop("n").join(sketched, "node").select("task", "family", "node", "component", "n", "sketch").groupBy("task").applyInArrow(_alike(rules), "a long,b long"), "minhash-alike")
        discard(sketched, wanted)
        merged = components(alike).select("node", F.xxhash64("component", F.lit(1)).alias("component"))
        families = stored(blocks(merged).withColumnRenamed("component", "family").unionByName(tied.where("k > 1").select("family", "node", "k", "salt", "block")), "minhash-families")
        discard(tied, alike)
        wanted = stored(dealt(families), "minhash-dealt")

        def compared(now: DataFrame, _) -> DataFrame:
            sets = sent(now.withColumnRenamed("task", "of")).withColumnRenamed("of", "task")
            return now.join(sets, ["task", "node"]).select("task", "family", "node", "component", "shingles").groupBy("task").applyInArrow(_within(rules), "a long,b long")

        links = links.unionByName(rounds(wanted, "task", WIDTH * F.col("n"), compared, "minhash-links"))
        discard(wanted)
        place = families.where("k > 1")
        if not place.isEmpty():
            # these are read more than once
            nodes = place.select("node").distinct().withColumn("of", F.array(F.lit(0).cast("long")))
            whole = made(nodes, _sets(size), _SETS, "minhash-shingles")
            sets = whole.drop("of")
            # a block that has members: with few of them a salt may have none
            some = place.groupBy("family").agg(F.min("salt").alias("salt"))
            lead = place.join(some, ["family", "salt"], "left_semi").join(sets, "node").select(F.pmod(F.xxhash64("family"), F.lit(n_tasks)).alias("task"), "family", "shingles")
            centres = stored(lead.groupBy("task").applyInArrow(_centres, "family long,core binary"), "minhash-centres")

            def apart(place: DataFrame, elements: bool) -> DataFrame:
                mine = place.join(sets, "node").select(task, "block", "family", "node", "shingles")
                heads = place.select("family", "k").distinct().join(centres, "family").select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("salt"), "core")
                heads = heads.select(F.xxhash64("family", "salt").alias("block"), "core").select("block", "core", task.alias("head_task"))
                return mine.groupBy("task").cogroup(heads.groupBy("head_task")).applyInArrow(_apart(rules, elements), _ELEMENTS if elements else _STANDING)

            def standing_in(labels: DataFrame) -> DataFrame:
                """Members of families that still hold several components, with their component."""
                named = standing.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
                mixed = named.groupBy("family").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("family")
                return named.join(mixed, "family", "left_semi")

            standing = stored(apart(place, False), "minhash-standing")
            release(spark)
            nearest = standing.groupBy("family").agg(F.min_by("node", F.struct("excess", "node")).alias("r"))
            first = stored(standing_in(components(links)).select("family", "node", "component"), "minhash-first")
            own = first.join(nearest.withColumnRenamed("r", "node"), ["family", "node"]).select("family", F.col("node").alias("r"), F.col("component").alias("r_component"))
            direct = first.join(own, "family").where("component <> r_component").select(F.least("node", "r").alias("a"), F.greatest("node", "r").alias("b")).distinct()
            direct = stored(direct, "minhash-direct")
            links = links.unionByName(confirmed(direct))
            discard(first, direct)
            release(spark)

            rest = stored(standing_in(components(links)), "minhash-rest")
            tops = rest.join(nearest, "family").where("node = r").select("family", F.col("component").alias("r_component"), F.col("excess").alias("m1"))
            rest = rest.join(tops, "family").withColumn("inside", F.col("component") == F.col("r_component"))
            outer = rest.where("not inside").groupBy("family").agg(F.min("excess").alias("m2"))
            scale = 2 * (100 + percent)
            rest = rest.join(outer, "family")
            rest = rest.withColumn("few", F.expr(f"n + 1 - greatest(1, ceil((excess + m2) / {scale}))"))
            rest = rest.withColumn("most", F.expr(f"if(inside, few, greatest(few, n + 1 - greatest(1, ceil((excess + m1) / {scale}), ceil((excess - least) / 200))))"))
            rest = stored(rest.select("family", "node", "component", "inside", "n", "excess", "few", "most").where("most > 0"), "minhash-rest")
            found = stored(apart(place.join(rest.select("family", "node"), ["family", "node"], "left_semi"), True), "minhash-differences")
            shared = found.groupBy("family", "element").count().where("count > 1")
            mine = found.join(shared, ["family", "element"])
            of = W.partitionBy("family", "node")
            ranked = mine.select("family", "node", "element", F.row_number().over(of.orderBy("count", "element")).alias("at"), F.count(F.lit(1)).over(of).alias("m"))
            ranked = ranked.join(rest, ["family", "node"]).withColumn("at", F.col("n") - F.col("m") + F.col("at")).where("at <= most")
            ranked = stored(ranked.select("family", "element", "node", "component", "inside", "n", "excess", (F.col("at") <= F.col("few")).alias("short")), "minhash-ranked")
            discard(found, rest)
            x, y = (ranked.select("family", "element", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "inside", "short", "excess", "n")]) for s in "xy")
            possible = F.expr(f"excess_x + excess_y <= {scale} * least(n_x, n_y)")
            once = F.col("inside_x") | (F.col("short_y") & (F.col("node_x") < F.col("node_y")))
            met = x.where("short_x").join(y.where("not inside_y"), ["family", "element"]).where((F.col("component_x") != F.col("component_y")) & once & possible)
            pairs = stored(met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct(), "minhash-between")
            discard(whole, centres, standing, ranked)
            release(spark)
            if not pairs.isEmpty():
                links = links.unionByName(confirmed(pairs))
            discard(pairs)
        discard(families)
    labels = components(links)
    named = reps.select("node", "rep").join(labels, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    tops = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    tops = named.select("node", "component").join(tops, "component").select("node", "component_id")
    marked = full.select("doc_id", "n_shingles", "node").join(tops, "node").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return marked.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))
