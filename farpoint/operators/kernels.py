"""Numpy kernels run inside Spark tasks (applyInPandas / mapInPandas).

They only see one tile / group / batch that Spark has already partitioned;
nothing here reads or writes data on its own.  Squared distances come from
the Gram identity (BLAS; for farthest pairs in single precision with a bound
on its error, chunk by chunk) and every value that decides a result is
recomputed exactly from coordinate differences, so answers match a plain
``sum((a - b)^2)``.

One rule for odd values: a NaN distance never wins and is never chosen, an
infinite distance counts like any other; a mean with a NaN distance is NaN.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

# bytes of one float64 work matrix (rows x cols) per chunk
CHUNK_BYTES = 64 << 20
# rows per step of a scan over coordinates
CHUNK_ROWS = 16_384
# rows x columns of a single-precision chunk of distances: small enough for the cache
FAST_ROWS, FAST_COLS = 512, 2048
# larger coordinates are compared by differences: squares could overflow
MAX_FAST = 1e150


def stack(col: pd.Series) -> np.ndarray:
    """Series of equal-length arrays -> 2-d float64 matrix."""
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(x, dtype=np.float64) for x in col.to_numpy()])


def exact_sq(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise squared distance of two equal-shape matrices.

    Summed coordinate by coordinate, as ``functions.vectors.sqdist`` does, so
    all plans give the same double to the last bit.
    """
    out = np.zeros(len(a))
    with np.errstate(invalid="ignore", over="ignore"):
        for j in range(a.shape[1] if a.ndim == 2 else 0):
            d = a[:, j] - b[:, j]
            out += d * d
    return out


def exact_pairs(xa, xb, r, c) -> np.ndarray:
    """Exact squared distances of the index pairs (xa[r], xb[c]).

    Candidate lists can be long when many points are copies of each other
    (every copy ties), so the differences are formed in bounded batches.
    """
    out = np.empty(len(r), dtype=np.float64)
    step = max(1, CHUNK_BYTES // (8 * max(1, xa.shape[1] if xa.ndim == 2 else 1)))
    for s in range(0, len(r), step):
        e = min(len(r), s + step)
        out[s:e] = exact_sq(xa[r[s:e]], xb[c[s:e]])
    return out


def _gram_sq(xa, na, xb, nb):
    """Squared distances by the Gram identity; rows whose norm is not finite by differences."""
    with np.errstate(invalid="ignore", over="ignore"):
        g = na[:, None] + nb[None, :] - 2.0 * (xa @ xb.T)
    np.maximum(g, 0.0, out=g)
    for i in np.flatnonzero(~np.isfinite(na)):
        g[i] = exact_sq(np.broadcast_to(xa[i], xb.shape), xb)
    for j in np.flatnonzero(~np.isfinite(nb)):
        g[:, j] = exact_sq(xa, np.broadcast_to(xb[j], xa.shape))
    return g


def _tol(na, nb):
    # absolute error bound of the Gram form, generously widened (NaN rows ignored)
    fa = na[np.isfinite(na)]
    fb = nb[np.isfinite(nb)]
    return 1e-9 * (fa.max(initial=0.0) + fb.max(initial=0.0) + 1.0)


def _row_chunks(na_rows, nb_rows):
    step = max(1, CHUNK_BYTES // (8 * max(1, nb_rows)))
    for s in range(0, na_rows, step):
        yield s, min(na_rows, s + step)


def _fast_rows(x) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.abs(x).max(axis=1, initial=0.0) < MAX_FAST         # False for NaN


def _fast_sq(xa, xb, triangle=False):
    """``(unit, tol, chunks)``: squared distances in single precision, in units of ``unit``.

    Both sets are centred and scaled, so the error depends on their extent only.  A
    chunk is (s, e, t, u, g), g the distances of rows s:e of A to rows t:u of B; g is used
    again by the next one.  ``tol`` is more than twice the largest error of an entry.
    ``triangle`` (A is B): chunks below the diagonal are left out.
    """
    dim = xa.shape[1]
    c = xa.mean(axis=0)
    a, b = xa - c, xb - c
    scale = max(np.abs(a).max(), np.abs(b).max(), 1e-140)
    a, b = a / scale, b / scale
    na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    r = np.sqrt(max(na.max(), nb.max()))
    # rounding of the product, its inputs and the norms; of the centring; of the exact form
    shift = 2.0 ** -51 * np.sqrt(dim) * max(np.abs(xa).max(), np.abs(xb).max()) / scale
    err = (dim + 8) * 2.0 ** -24 * 4 * r * r + 8 * r * shift + 4 * shift * shift + 1e-30
    left = np.column_stack([-2.0 * a, na, np.ones(len(a))]).astype(np.float32)
    right = np.ascontiguousarray(np.column_stack([b, np.ones(len(b)), nb]).astype(np.float32).T)

    def chunks():
        buf = np.empty(FAST_ROWS * FAST_COLS, np.float32)
        for s in range(0, len(left), FAST_ROWS):
            e = min(len(left), s + FAST_ROWS)
            for t in range(s // FAST_COLS * FAST_COLS if triangle else 0, right.shape[1], FAST_COLS):
                u = min(right.shape[1], t + FAST_COLS)
                g = buf[:(e - s) * (u - t)].reshape(e - s, u - t)
                np.matmul(left[s:e], right[:, t:u], out=g)
                yield s, e, t, u, g

    return scale * scale, 2.5 * err, chunks()


def _max_sq_masked(xa, ida, xb, idb, triangle, best):
    """``max_sq`` in double precision, for any coordinates and a triangle of two sets."""
    na, nb = np.einsum("ij,ij->i", xa, xa), np.einsum("ij,ij->i", xb, xb)
    tol = _tol(na, nb)
    for s, e in _row_chunks(len(ida), len(idb)):
        g = _gram_sq(xa[s:e], na[s:e], xb, nb)
        valid = ~np.isnan(g)
        if triangle:
            valid &= ida[s:e, None] < idb[None, :]
        if not valid.any():
            continue
        g = np.where(valid, g, -np.inf)
        m = g.max()
        r, c = np.nonzero(g >= m - tol)
        ex = exact_pairs(xa, xb, s + r, c)
        ex = ex[~np.isnan(ex)]
        if len(ex):
            v = float(ex.max())
            best = v if best is None else max(best, v)
    return best


def max_sq(xa, ida, xb, idb, triangle: bool, best: float | None = None) -> float | None:
    """Largest squared distance over pairs (a, b), or ``best`` if that is larger; ``triangle``: only ida < idb.

    NaN distances are ignored; ``None`` when there is no pair (and no ``best``).
    """
    if len(ida) == 0 or len(idb) == 0:
        return best
    if (triangle and xa is not xb) or not (_fast_rows(xa).all() and _fast_rows(xb).all()):
        return _max_sq_masked(xa, ida, xb, idb, triangle, best)
    unit, tol, chunks = _fast_sq(xa, xb, triangle)
    for s, e, t, u, g in chunks:
        m = g.max()
        low = m if best is None else max(m, best / unit)
        if m < low - tol:
            continue
        at = np.flatnonzero(g >= low - tol)
        r, c = at // (u - t), at % (u - t)
        if triangle:                    # all pairs of a set: either order is one of them
            other = ida[s + r] != idb[t + c]
            r, c = r[other], c[other]
        if len(r):
            v = float(exact_pairs(xa, xb, s + r, t + c).max())
            best = v if best is None else max(best, v)
    return best


def sum_dist(xa, ida, xb, idb, triangle: bool) -> tuple[float, int]:
    """Sum of Euclidean distances and number of pairs; ``triangle``: ida < idb."""
    total, count = 0.0, 0
    if len(ida) == 0 or len(idb) == 0:
        return total, count
    na, nb = np.einsum("ij,ij->i", xa, xa), np.einsum("ij,ij->i", xb, xb)
    tol = _tol(na, nb)
    for s, e in _row_chunks(len(ida), len(idb)):
        g = _gram_sq(xa[s:e], na[s:e], xb, nb)
        keep = (ida[s:e, None] < idb[None, :]) if triangle else np.ones(g.shape, bool)
        # near-zero distances lose relative precision in the Gram form: redo exactly
        small = keep & (g < 1e3 * tol)
        if small.any():
            r, c = np.nonzero(small)
            g[r, c] = exact_pairs(xa, xb, s + r, c)
        total += float(np.sqrt(g[keep]).sum())
        count += int(keep.sum())
    return total, count


def _keep_better(d, p, rows, ex, ids):
    """Of each row the larger distance, then the smaller id."""
    o = np.lexsort((ids, -ex, rows))
    rows, ex, ids = rows[o], ex[o], ids[o]
    first = np.ones(len(rows), bool)
    first[1:] = rows[1:] != rows[:-1]
    rows, ex, ids = rows[first], ex[first], ids[first]
    win = (ex > d[rows]) | ((ex == d[rows]) & (ids < p[rows]))
    d[rows[win]], p[rows[win]] = ex[win], ids[win]


def _equal_ids(ida, idb):
    """Positions (in A, in B) of equal ids, by position in A."""
    order = np.argsort(idb, kind="stable")
    lo, hi = (np.searchsorted(idb, ida, side, sorter=order) for side in ("left", "right"))
    r = np.repeat(np.arange(len(ida)), hi - lo)
    at = np.arange(len(r)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[r]
    return r, order[at]


def _candidates(g, best, tol):
    """Entries of g that may be their row's largest and not below the row's best so far."""
    m = g.max(axis=1)
    rows = np.flatnonzero((m >= best - tol) & (m > -np.inf))
    if len(rows) == 0:
        return rows, rows
    at = np.flatnonzero(g[rows] >= (np.maximum(m[rows], best[rows]) - tol)[:, None])     # faster than in two dimensions
    return rows[at // g.shape[1]], at % g.shape[1]


def partners(xa, ida, xb, idb, both: bool):
    """``best_partner`` of A in B and, with ``both``, of B in A, from one pass over the distances."""
    da, pa = np.full(len(ida), -np.inf), np.full(len(ida), np.iinfo(np.int64).max)
    db, pb = np.full(len(idb), -np.inf), np.full(len(idb), np.iinfo(np.int64).max)
    if len(ida) and len(idb):
        fa, fb = _fast_rows(xa), _fast_rows(xb)
        # rows with an infinite or huge coordinate: by differences; with a NaN: no distance
        for i in np.flatnonzero(~fa & ~np.isnan(xa).any(axis=1)):
            ex = exact_sq(np.broadcast_to(xa[i], xb.shape), xb)
            j = np.flatnonzero((idb != ida[i]) & ~np.isnan(ex))
            _keep_better(da, pa, np.full(len(j), i), ex[j], idb[j])
            _keep_better(db, pb, j, ex[j], np.full(len(j), ida[i]))
        for j in np.flatnonzero(~fb & ~np.isnan(xb).any(axis=1)):
            ex = exact_sq(xa, np.broadcast_to(xb[j], xa.shape))
            i = np.flatnonzero((ida != idb[j]) & ~np.isnan(ex))
            _keep_better(da, pa, i, ex[i], np.full(len(i), idb[j]))
            _keep_better(db, pb, np.full(len(i), j), ex[i], ida[i])
        if fa.any() and fb.any():
            at_a, at_b = np.flatnonzero(fa), np.flatnonzero(fb)
            ya, yb = (xa, xb) if fa.all() and fb.all() else (xa[at_a], xb[at_b])
            same_r, same_c = _equal_ids(ida[at_a], idb[at_b])
            unit, tol, chunks = _fast_sq(ya, yb)
            for s, e, t, u, g in chunks:
                lo, hi = np.searchsorted(same_r, [s, e])
                sr, sc = same_r[lo:hi], same_c[lo:hi]
                here = (sc >= t) & (sc < u)
                g[sr[here] - s, sc[here] - t] = -np.inf
                r, c = _candidates(g, da[at_a[s:e]] / unit, tol)
                if len(r):
                    _keep_better(da, pa, at_a[s + r], exact_pairs(ya, yb, s + r, t + c), idb[at_b[t + c]])
                if both:
                    m = g.max(axis=0)
                    cols = np.flatnonzero((m >= db[at_b[t:u]] / unit - tol) & (m > -np.inf))
                    if len(cols):
                        c, r = _candidates(np.ascontiguousarray(g[:, cols].T), db[at_b[t + cols]] / unit, tol)
                        c = cols[c]
                        _keep_better(db, pb, at_b[t + c], exact_pairs(ya, yb, s + r, t + c), ida[at_a[s + r]])
    a = da > -np.inf
    if not both:
        return ida[a], pa[a], da[a]
    b = db > -np.inf
    return np.concatenate([ida[a], idb[b]]), np.concatenate([pa[a], pb[b]]), np.concatenate([da[a], db[b]])


def best_partner(xa, ida, xb, idb):
    """For each row of A, its farthest row of B with a different id.

    Ties go to the smallest partner id; NaN distances never win.  Returns
    (ids of A rows that have a partner, partner ids, exact squared distances).
    """
    return partners(xa, ida, xb, idb, both=False)


def nearest(x, cx, cid, crank):
    """For each row of x: nearest center (ties: smaller rank) and its distance.

    Gram-form distances to all centers (BLAS, chunked), exact re-check of
    every center within rounding of the row minimum; rows whose distances
    are all NaN get center -1 and distance inf.
    """
    n = len(x)
    best_c = np.full(n, -1, dtype=np.int64)
    best_d = np.full(n, np.inf)
    if n == 0 or len(cid) == 0:
        return best_c, best_d
    order = np.argsort(crank, kind="stable")           # centers in rank order
    cx, cid = cx[order], cid[order]
    nx, nc = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", cx, cx)
    tol = _tol(nx, nc)
    for s, e in _row_chunks(n, len(cid)):
        g = _gram_sq(x[s:e], nx[s:e], cx, nc)
        bad = np.isnan(g)
        g = np.where(bad, np.inf, g)
        m = g.min(axis=1)
        r, c = np.nonzero((g <= (m + tol)[:, None]) & ~bad)
        if len(r) == 0:
            continue
        ex = exact_pairs(x, cx, s + r, c)
        ex = np.where(np.isnan(ex), np.inf, ex)
        o = np.lexsort((c, ex, r))                     # per row: smallest, then rank
        r, c, ex = r[o], c[o], ex[o]
        first = np.ones(len(r), bool)
        first[1:] = r[1:] != r[:-1]
        best_c[s + r[first]] = cid[c[first]]
        best_d[s + r[first]] = np.sqrt(ex[first])
    return best_c, best_d


def farthest_first(ids, x, k):
    """Farthest-first traversal from the smallest id: list of (step, id).

    Stops early when every remaining point coincides with a center, so the
    result has at most min(k, number of distinct points) centers.
    """
    return [(step, i) for step, i, _ in farthest_first_chunks([(ids, x)], k)]


def farthest_first_chunks(chunks, k):
    """``farthest_first`` of a set that comes in chunks (ids, x): list of (step, id, coordinates).

    Of a point only its id, coordinates and distance are held: 8 * (dimension + 2) bytes.
    Ties go to the smallest id, whatever the chunks.
    """
    cut = [(ids[s:s + CHUNK_ROWS], x[s:s + CHUNK_ROWS])
           for ids, x in chunks for s in range(0, len(ids), CHUNK_ROWS)]
    if not cut or k < 1:
        return []
    i, v = min(((int(ids[j]), x[j]) for ids, x in cut for j in [np.argmin(ids)]), key=lambda p: p[0])
    picks = [(0, i, v)]
    dist = [np.full(len(ids), np.nan) for ids, _ in cut]
    for step in range(1, k):
        best = (0.0, 0, None)
        for (ids, x), d in zip(cut, dist):
            np.fmin(d, np.sqrt(exact_sq(x, np.broadcast_to(v, x.shape))), out=d)     # NaN: not farther, not nearer
            m = np.fmax.reduce(d)
            if m > 0 and m >= best[0]:
                at = np.flatnonzero(d == m)
                j = at[np.argmin(ids[at])]
                if m > best[0] or ids[j] < best[1]:
                    best = (m, int(ids[j]), x[j])
        _, i, v = best
        if v is None:
            break
        picks.append((step, i, v))
    return picks


def batch_points(batches):
    """(ids, x) of each batch of a group, as compact arrays; the frames are let go."""
    for pdf in batches:
        if len(pdf):
            yield pdf["id"].to_numpy(np.int64, copy=True), stack(pdf["v"])


def greedy_pairs(ids, x, k):
    """Greedy farthest pairs of one bounded set: list of picked ids in order.

    k // 2 times the farthest pair of unused points (ties: smallest i, then
    j, with i < j), then the smallest unused ids up to k (one for odd k, more
    when NaN points leave pairs out); all ids in order when k >= n.  Partners are kept per point and recomputed only for points
    whose partner was used, so memory stays at one chunk.
    """
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    n = len(ids)
    if k >= n:
        return [int(i) for i in ids]
    pos = {int(v): i for i, v in enumerate(ids)}
    partner = np.full(n, -1, dtype=np.int64)      # position of the partner
    pd2 = np.full(n, -np.inf)
    i_, p_, d_ = best_partner(x, ids, x, ids)
    for a, b, d in zip(i_, p_, d_):
        partner[pos[int(a)]], pd2[pos[int(a)]] = pos[int(b)], d
    alive = np.ones(n, bool)
    picks = []
    for _ in range(k // 2):
        cand = np.nonzero(alive & (partner >= 0))[0]
        if len(cand) == 0:
            break
        lo = np.minimum(cand, partner[cand])
        hi = np.maximum(cand, partner[cand])
        o = np.lexsort((hi, lo, -pd2[cand]))       # d desc, then i, then j
        a, b = int(lo[o[0]]), int(hi[o[0]])
        picks += [int(ids[a]), int(ids[b])]
        alive[a] = alive[b] = False
        stale = np.nonzero(alive & ((partner == a) | (partner == b)))[0]
        if len(stale):
            live = np.nonzero(alive)[0]
            i_, p_, d_ = best_partner(x[stale], ids[stale], x[live], ids[live])
            partner[stale], pd2[stale] = -1, -np.inf
            for ai, bi, d in zip(i_, p_, d_):
                partner[pos[int(ai)]], pd2[pos[int(ai)]] = pos[int(bi)], d
    rest = ids[np.nonzero(alive)[0]][:k - len(picks)]
    return picks + [int(i) for i in rest]
