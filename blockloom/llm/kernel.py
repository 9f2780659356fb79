"""Vectorised text kernels shared by the corpus operators.

Texts reach Python as Arrow buffers and are handled as one byte array per slice; no Python string is made per
word.  A word is a run of bytes outside ``\\x20\\x09-\\x0D``, so byte logic on UTF-8 equals ``[^\\x20\\x09-\\x0D]+``.
Sequences are hashed with a polynomial over 64 bits and a final avalanche; every range of a sequence then costs
one subtraction and two products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 20
_P = U64(0x9E3779B97F4A7C15 | 1)
_PINV = U64(pow(int(_P), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x):
    """Avalanche of 64-bit values (the splitmix64 finaliser)."""
    x = np.asarray(x, U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_HASH = mix(np.arange(256, dtype=U64) + U64(0xC0FFEE))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, kept for the life of the worker."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_P, _PINV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _POWERS[k] = np.multiply.accumulate(a)
    return _POWERS[0], _POWERS[1]


class Ranges:
    """Hashes of ranges ``[lo, hi)`` of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        up, _ = powers(len(symbols))
        self.sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def __call__(self, lo, hi):
        _, down = powers(len(self.sums))
        return mix((self.sums[hi] - self.sums[lo]) * down[lo])


def slices(batches, text: str, limit: int = SLICE_BYTES):
    """``(record batch, bytes, offsets)`` for runs of rows of about ``limit`` bytes; a null text is empty."""
    for rb in batches:
        if not rb.num_rows:
            continue
        col = pc.fill_null(pc.cast(rb.column(rb.schema.get_field_index(text)), pa.large_binary()), b"")
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield rb.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
            at = end


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses a document boundary."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prev = np.empty(n, bool)
    prev[0], prev[1:] = False, mask[:-1]
    prev[offs[:-1][offs[:-1] < n]] = False
    follow = np.empty(n, bool)
    follow[-1], follow[:-1] = False, mask[1:]
    ends = offs[1:]
    follow[ends[ends > 0] - 1] = False
    return np.flatnonzero(mask & ~prev), np.flatnonzero(mask & ~follow) + 1


def owner(offs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the document that holds each byte position."""
    return np.searchsorted(offs, at, "right") - 1


def counts(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each document."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


class Words:
    """Words of a slice: ``start``, ``end``, ``doc``, and ``first``, the offsets of each document's words."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.mask = ~SPACE[data]
        self.start, self.end = runs(self.mask, offs)
        self.doc = owner(offs, self.start)
        self.n = np.bincount(self.doc, minlength=len(offs) - 1).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return Ranges(BYTE_HASH[data])(self.start, self.end)


def duplicated(keys: np.ndarray) -> np.ndarray:
    """True for every element whose value occurs twice or more."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    out = np.zeros(len(keys), bool)
    hit = np.zeros(len(keys), bool)
    hit[1:], hit[:-1] = same, hit[:-1] | same
    hit[1:] |= same
    out[order] = hit
    return out


def planes(a: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned integers, one byte plane after another: high planes compress away."""
    le = np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(le[:, :width].T).tobytes()


def unplanes(blob: bytes, width: int) -> np.ndarray:
    m = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((m.shape[1], 8), np.uint8)
    out[:, :width] = m.T
    return out.reshape(-1).view("<u8").astype(U64)


def table(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(","))])
