"""Nearest center among very many centers (A19/J5) by triangle-inequality bounds.

With k centers the plain scan computes n * k distances.  Here the centers are grouped
around about sqrt(k) pivots (centers themselves, chosen farthest-first).  A point's
distance to a center c of a group with pivot g and radius R is at least d(p, g) - R, so
after the group of its nearest pivot a point only looks into groups whose bound does
not exceed the distance it has.  In low dimension or with clustered centers most groups are
skipped; where nothing can be skipped, sqrt(k) distances a point are wasted.

The answer is exact: every distance that decides is computed from coordinate
differences, ties go to the earlier center, NaN distances never win, and points or
centers with a coordinate that is not finite are compared with all centers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators import kernels as K

FIRST_WAVES = 3             # groups of the nearest pivots that every point looks into first


@dataclass
class CenterGroups:
    """Centers by group: ids, ranks and coordinates of each; pivots and radii."""

    pivots: np.ndarray
    radius: np.ndarray
    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    rest: tuple[np.ndarray, np.ndarray, np.ndarray]         # centers that are not finite

    @classmethod
    def build(cls, cid: np.ndarray, cx: np.ndarray, crank: np.ndarray, n_groups: int | None = None):
        ok = np.isfinite(cx).all(axis=1) if len(cid) else np.zeros(0, bool)
        rest = (cid[~ok], crank[~ok], cx[~ok])
        cid, crank, cx = cid[ok], crank[ok], cx[ok]
        m = n_groups or max(1, math.isqrt(len(cid)))
        picks = [i for _, i in K.farthest_first(np.arange(len(cid)), cx, m)]
        pivots = cx[picks]
        if not picks:
            return cls(np.zeros((0, 0)), np.zeros(0), [], rest)
        own, d = K.nearest(cx, pivots, np.arange(len(picks)), np.arange(len(picks)))
        groups, radius = [], np.zeros(len(picks))
        for g in range(len(picks)):
            on = own == g
            groups.append((cid[on], crank[on], cx[on]))
            radius[g] = d[on].max(initial=0.0)
        return cls(pivots, radius, groups, rest)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(center id or -1, distance or inf, number of distances computed) per row of ``x``."""
        n, m = len(x), len(self.groups)
        best_c, best_d = np.full(n, -1, np.int64), np.full(n, np.inf)
        best_r, n_dist = np.full(n, np.iinfo(np.int64).max), np.full(n, m, np.int64)

        def look(rows, group):
            cid, crank, cx = group
            if not len(rows) or not len(cid):
                return
            c, d = K.nearest(x[rows], cx, cid, crank)
            order = np.argsort(cid, kind="stable")
            r = np.where(c >= 0, crank[order[np.minimum(np.searchsorted(cid[order], c), len(cid) - 1)]],
                         np.iinfo(np.int64).max)
            better = (c >= 0) & ((d < best_d[rows]) | ((d == best_d[rows]) & (r < best_r[rows])))
            at = rows[better]
            best_c[at], best_d[at], best_r[at] = c[better], d[better], r[better]
            n_dist[rows] += len(cid)

        every = np.arange(n)
        look(every, self.rest)
        odd = ~np.isfinite(x).all(axis=1) if n else np.zeros(0, bool)
        for g in self.groups:
            look(every[odd], g)
        rows = every[~odd]
        if not len(rows) or not m:
            return best_c, best_d, n_dist
        y = x[rows]
        ny, npv = np.einsum("ij,ij->i", y, y), np.einsum("ij,ij->i", self.pivots, self.pivots)
        for s, e in K._row_chunks(len(rows), m):
            at = rows[s:e]
            g2 = K._gram_sq(y[s:e], ny[s:e], self.pivots, npv)
            # the Gram form is off by a multiple of the norms' rounding: widen the bounds by it
            slack = np.sqrt(K._tol(ny[s:e], npv)) * 2
            dist = np.sqrt(g2)
            bound = dist - self.radius - slack
            waves = min(FIRST_WAVES, m)
            near = np.argsort(dist, axis=1)[:, :waves]
            seen = np.zeros(dist.shape, bool)
            for w in range(waves):
                mine = near[:, w]
                for g in np.unique(mine):
                    on = np.flatnonzero((mine == g) & (bound[:, g] <= best_d[at]))
                    look(at[on], self.groups[g])
                    seen[on, g] = True
            for g in range(m):
                look(at[(bound[:, g] <= best_d[at]) & ~seen[:, g]], self.groups[g])
        return best_c, best_d, n_dist


def nearest_by_groups(points: DataFrame, groups: CenterGroups, counted: bool = False) -> DataFrame:
    """``(id, center_id, dist)`` by a map-only scan; ``counted`` adds ``n_dist``, the distances computed.

    ``groups`` must fit a broadcast (``bounded.fits_broadcast`` of the centers).
    """
    shared = points.sparkSession.sparkContext.broadcast(groups)

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            c, d, n = shared.value.nearest(K.stack(pdf["v"]))
            out = pd.DataFrame({"id": pdf["id"].to_numpy(np.int64), "center_id": c, "dist": d, "n_dist": n})
            yield out

    rows = points.select("id", "v").mapInPandas(run, "id long, center_id long, dist double, n_dist long")
    found = F.col("center_id") >= 0
    return rows.select("id", F.when(found, F.col("center_id")).alias("center_id"),
                       F.when(found, F.col("dist")).alias("dist"), *(["n_dist"] if counted else []))
