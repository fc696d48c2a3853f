"""Windows of a symbol sequence and their minimizers (numpy inside tasks).

Shared by the two searches for repeated passages.  A window is ``width``
symbols (bytes or words) of one document; its minimizer is the gram of ``gram``
symbols with the least hash inside it (the leftmost of equal ones).  The
choice depends on the window's content alone, so equal windows have equal
minimizers at equal distances; a window can occur twice only if its minimizer
gram does.  Neighbouring windows share minimizers: about 2 / (width - gram) of
the positions carry one, which is what keeps the shuffles small.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from farpoint.llm import words as W

U = W.U
_R = U(0xD1342543DE82EF95)
_RINV = U(pow(0xD1342543DE82EF95, -1, 1 << 64))
BYTE_SYMBOL = W.mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))

_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _tables.get(int(base))
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 12), base, U)
        full[0] = 1
        have = _tables[int(base)] = np.cumprod(full, dtype=U)
    return have[:n]


class Sequence:
    """Symbols of the documents of a chunk with O(1) fingerprints of any range."""

    def __init__(self, sym: np.ndarray, off: np.ndarray):
        self.n, self.off = len(sym), off
        self.sums = np.zeros(len(sym) + 1, U)
        np.cumsum(sym * _powers(_R, len(sym)), dtype=U, out=self.sums[1:])
        self.inv = _powers(_RINV, len(sym) + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the symbol ranges ``start:end``."""
        h = (self.sums[end] - self.sums[start]) * self.inv[start]
        return W.mix(h ^ ((end - start).astype(U) * U(0xC2B2AE3D27D4EB4F)))

    def all_of(self, width: int) -> np.ndarray:
        """Fingerprints of the ``width`` symbols from every position (documents ignored)."""
        if self.n < width:
            return np.zeros(0, U)
        h = (self.sums[width:] - self.sums[:-width]) * self.inv[:self.n - width + 1]
        return W.mix(h ^ U(width * 0xC2B2AE3D27D4EB4F % (1 << 64)))


@dataclass
class Runs:
    """Maximal runs of windows with one minimizer: windows ``lo .. hi`` of document ``doc``.

    ``at``: the minimizer's position, ``gram``: its fingerprint, ``span``:
    fingerprint of everything the windows cover and of the minimizer's place in it.
    """

    doc: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    gram: np.ndarray
    span: np.ndarray


def minimizer_runs(seq: Sequence, width: int, gram: int) -> Runs:
    none = np.zeros(0, np.int64)
    g = seq.all_of(gram)
    m = W.sliding_min(((g >> U(32)) << U(32)) | np.arange(len(g), dtype=U), width - gram + 1)
    # a window must lie in one document: starts off[i] .. off[i + 1] - width
    ok = np.zeros(len(m) + 1, np.int32)
    a, z = seq.off[:-1], seq.off[1:] - width + 1
    a, z = a[z > a], z[z > a]
    np.add.at(ok, a, 1)
    np.add.at(ok, z, -1)
    s = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
    if not len(s):
        return Runs(none, none, none, none, np.zeros(0, U), np.zeros(0, U))
    at = (m[s] & U(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(seq.off, s, "right") - 1
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
    lo, hi = s[first], s[np.append(first[1:], len(s)) - 1]
    at, doc = at[first], doc[first]
    span = W.mix(seq.ranges(lo, hi + width) ^ W.mix((at - lo).astype(U)))
    return Runs(doc, at, lo, hi, g[at], span)


def byte_sequence(c: W.Chunk) -> Sequence:
    return Sequence(BYTE_SYMBOL[c.buf], c.off)


def word_sequence(w: W.Words) -> Sequence:
    return Sequence(w.hash, w.first)


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the ranges ``start:end`` as maximal disjoint ranges (touching ones joined)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.append(True, start[1:] > end[:-1])
    return start[first], end[np.append(np.flatnonzero(first)[1:], len(start)) - 1]
