"""Farthest-first traversal (D3, A16, A18) with lazy bounds per block.

The plain loop reads every point in every step.  Here the points are written once,
clustered into blocks around pivots (range partitioned by block and distance from the
pivot, so that a filter on blocks skips files and row groups), and a small table on the
driver keeps of every block its farthest point and that point's distance M to the
centers.  A distance to the nearest center only falls, so M stays an upper bound; and if a new
center is at least M away from the block's farthest point, that point and M stay
exact without a look at the block.  A step therefore reads only blocks that lost
their farthest point and whose bound still reaches the best exact M.

The driver holds one point per block (at most PIVOTS * RINGS) and the k centers.
Picks and ties equal ``centers.farthest_first_centers``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators import kernels as K
from farpoint.operators.sampling import random_sample
from farpoint.session import ensure_checkpoint_dir

PIVOTS = 64
RINGS = 4                 # blocks of a pivot, by distance from it
SAMPLE = 2048             # points from which the pivots are chosen
REFRESH = 16              # blocks read by one job, at most
PIVOT_SEED = 97


@dataclass
class _Far:
    """The farthest point of a block: exact, or only a bound."""

    n: int
    id: int | None
    v: np.ndarray | None
    dist: float
    exact: bool = True

    def key(self):
        return (self.dist, -(self.id if self.id is not None else 0))


def clustered(points: DataFrame, n_pivots: int = PIVOTS, rings: int = RINGS) -> DataFrame:
    """``(block, r, id, v)``: the points as a written table, in the order of blocks.

    Points with a NaN coordinate have no distance and are left out.
    """
    spark = points.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    rows = random_sample(points.select("id", "v"), SAMPLE, PIVOT_SEED).collect()
    x = np.array([r["v"] for r in rows], np.float64) if rows else np.zeros((0, 0))
    x = x[np.isfinite(x).all(axis=1)] if len(x) else x
    picks = [i for _, i in K.farthest_first(np.arange(len(x)), x, n_pivots)]
    pivots = x[picks]
    far = 1.0
    if len(picks):
        _, d = K.nearest(x, pivots, np.arange(len(picks)), np.arange(len(picks)))
        far = float(d.max()) or 1.0
    shared = spark.sparkContext.broadcast((pivots, far))

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            y = K.stack(pdf["v"])
            piv, far = shared.value
            c, r = K.nearest(y, piv, np.arange(len(piv)), np.arange(len(piv)))
            ring = np.minimum(np.where(np.isfinite(r), r, far) / far * rings, rings - 1).astype(np.int64)
            # points that are no finite distance from any pivot share the last block
            block = np.where(c < 0, len(piv) * rings, c * rings + ring)
            yield pd.DataFrame({"block": block.astype(np.int32), "r": r, "id": pdf["id"].to_numpy(np.int64),
                                "v": pdf["v"]})

    clean = points.select("id", "v").filter(~F.exists("v", lambda x: F.isnan(x)))
    out = clean.mapInPandas(run, "block int, r double, id long, v array<double>")
    path = f"{base}/clustered-{uuid.uuid4().hex}"
    # ids break up a block of copies, which are all at one distance
    out.repartitionByRange("block", "r", "id").sortWithinPartitions("block", "r").write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _farthest_of_blocks(table: DataFrame, blocks: list[int] | None, centers: np.ndarray) -> dict[int, _Far]:
    """The farthest point of every (given) block from its nearest center."""
    shared = table.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            cx = shared.value
            at = np.arange(len(cx))
            c, d = K.nearest(K.stack(pdf["v"]), cx, at, at)
            block, ids = pdf["block"].to_numpy(), pdf["id"].to_numpy(np.int64)
            d = np.where(c < 0, -1.0, d)                   # without a distance: never chosen
            order = np.lexsort((ids, -d, block))
            first = order[np.append(True, np.diff(block[order]) != 0)]
            n = np.diff(np.append(np.flatnonzero(np.append(True, np.diff(block[order]) != 0)), len(order)))
            yield pd.DataFrame({"block": block[first], "n": n.astype(np.int64), "id": ids[first],
                                "v": pdf["v"].iloc[first].to_numpy(), "dist": d[first]})

    part = table if blocks is None else table.filter(F.col("block").isin(blocks))
    rows = (part.mapInPandas(run, "block int, n long, id long, v array<double>, dist double").groupBy("block")
            .agg(F.sum("n").alias("n"), F.max_by(F.struct("id", "v", "dist"),
                                                 F.struct(F.col("dist"), -F.col("id"))).alias("b")).collect())
    return {r["block"]: _Far(r["n"], r["b"]["id"], np.array(r["b"]["v"], np.float64), r["b"]["dist"]) for r in rows}


def farthest_first_lazy(points: DataFrame, k: int, start_id: int | None = None,
                        n_pivots: int = PIVOTS, rings: int = RINGS) -> DataFrame:
    """``(step, id, rows_read)``: up to k centers, and the points read to find each of them.

    Start, ties and the early end are those of ``centers.farthest_first_centers``.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = points.sparkSession
    schema = "step int, id long, rows_read long"
    pts = points.select("id", "v")
    first = (pts.orderBy("id").limit(1) if start_id is None else pts.filter(F.col("id") == F.lit(start_id))).first()
    if first is None:
        if start_id is not None:
            raise ValueError(f"start id {start_id} not in the point set")
        return spark.createDataFrame([], schema)
    centers = [np.array(first["v"], np.float64)]
    picks = [(0, int(first["id"]), 0)]
    if k == 1:
        return spark.createDataFrame(picks, schema)
    table = clustered(pts, n_pivots, rings)
    far = _farthest_of_blocks(table, None, np.array(centers))
    read = sum(f.n for f in far.values())
    for step in range(1, k):
        while True:
            best = max((f.key() for f in far.values() if f.exact), default=(0.0, 0))
            # a bound that only ties may hide a smaller id
            due = sorted((b for b, f in far.items() if not f.exact and f.dist >= best[0] and f.dist > 0),
                         key=lambda b: (-far[b].dist, b))[:REFRESH]
            if not due:
                break
            far.update(_farthest_of_blocks(table, due, np.array(centers)))
            read += sum(far[b].n for b in due)
        top = max((f for f in far.values() if f.exact), key=_Far.key, default=None)
        if top is None or not top.dist > 0:
            break
        picks.append((step, int(top.id), read))
        centers.append(top.v)
        read = 0
        for f in far.values():
            if f.exact and f.id is not None:
                d = float(np.sqrt(K.exact_sq(f.v[None], top.v[None])[0]))
                # a NaN distance changes nothing, as in the plain loop
                f.exact = not d < f.dist
    return spark.createDataFrame(picks, schema)
