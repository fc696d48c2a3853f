"""Vectorised word, line and window hashes over Arrow text batches (numpy inside tasks).

A batch of texts is worked off in chunks of about ``CHUNK_BYTES`` bytes, so the
temporaries stay small however many or long the documents are; one longer
document is one chunk.  All hashes are 64-bit fingerprints; equality of two
fingerprints is taken as equality of the words (or windows) behind them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

U = np.uint64
_R = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_pow = np.ones(1, U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> U(30))
    x = x * _M1
    x = x ^ (x >> U(27))
    x = x * _M2
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    """r^0 .. r^(n-1) mod 2^64 (kept and grown)."""
    global _pow
    if len(_pow) < n:
        full = np.full(max(n, 1 << 12), _R, U)
        full[0] = 1
        _pow = np.cumprod(full, dtype=U)
    return _pow[:n]


@dataclass
class Chunk:
    """Rows ``lo:hi`` of a batch: bytes and offsets (document i is ``off[i]:off[i+1]``)."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


def give_back() -> None:
    """Return freed memory to the system: reused Python workers otherwise keep their largest use."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # a C library without it
        pass


def chunks(text: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut one Arrow string column into chunks of whole documents; null counts as empty."""
    if text.null_count:
        text = text.fill_null("")
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    n = len(text)
    if n == 0:
        return
    _, offs, data = text.buffers()
    off = np.frombuffer(offs, np.int64)[text.offset:text.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi
    give_back()


@dataclass
class Words:
    """Words of a chunk: byte ranges, document index, and the first word of each document."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def segment_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray,
                 take: np.ndarray | None = None) -> np.ndarray:
    """Fingerprints of the byte ranges ``start:end`` (ascending, disjoint, not empty).

    ``take``: bytes that count (others are skipped as zero, e.g. the gaps).
    """
    if not len(start):
        return np.zeros(0, U)
    length = (end - start).astype(np.int64)
    lo, hi = int(start[0]), int(end[-1])
    span = np.empty(len(start), np.int64)
    span[:-1] = start[1:] - start[:-1]
    span[-1] = hi - start[-1]
    pos = np.arange(hi - lo, dtype=np.int64) - np.repeat(start - lo, span)
    data = buf[lo:hi].astype(U) + U(1)
    data *= powers(int(span.max()) + 1)[pos]
    if take is not None:
        data[~take[lo:hi]] = 0
    h = np.add.reduceat(data, start - lo)
    return mix(h ^ (length.astype(U) * _M2))


def words(c: Chunk, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every document of the chunk."""
    buf = LOWER[c.buf] if lower else c.buf
    solid = ~IS_SPACE[buf]
    head = np.zeros(len(buf) + 1, bool)
    head[c.off] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | head[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | head[1:-1]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    first = np.searchsorted(s, c.off)
    doc = np.repeat(np.arange(c.n), np.diff(first))
    return Words(s, e, doc, first, segment_hash(buf, s, e, solid))


def windows(w: Words, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, fingerprint) of all k-word windows inside one document."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(w.doc[:n - k + 1] == w.doc[k - 1:])
    h = np.zeros(n - k + 1, U)
    for j in range(k):
        h = h * _R + w.hash[j:n - k + 1 + j]
    return at, mix(h[at] + U(seed * 2 + 1))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (block prefix and suffix minima)."""
    n = len(x)
    if n < w:
        return np.zeros(0, x.dtype)
    pad = -n % w
    big = np.iinfo(x.dtype).max
    y = np.concatenate([x, np.full(pad, big, x.dtype)]).reshape(-1, w)
    pre = np.minimum.accumulate(y, axis=1).ravel()
    suf = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n - w + 1], pre[w - 1:n])
