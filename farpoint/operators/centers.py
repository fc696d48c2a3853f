"""Farthest-first traversal (D3), k-center maximum distance (D4) and
nearest-center assignment (A19).

D3 is a loop of k-1 small jobs over the whole point set.  The state
``(id, v, dist)`` keeps each point's distance to its nearest center, so each
step is one scan that updates ``dist = least(dist, d(v, new))`` with the new
center as a literal (an array literal reused by one compiled plan, or, for a
large state, unrolled into generated code) and finds the farthest point,
ties to the smallest id, by a ``max_by`` aggregate (partial per task, merged on
an executor, one row to the driver).  The state is cached per step, so a
lost executor recomputes at most a few steps.  What is cut every few steps is
only the lineage: while the centers fit a broadcast, the state is computed
anew from the points and all centers so far (a map-only scan), so no vector is
ever written; beyond that it is checkpointed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.functions.vectors import dist_to_const
from farpoint.operators import kernels as K
from farpoint.operators.bounded import (
    collect_bounded,
    fits_broadcast,
    nearest_in_set,
    semi_by_ids,
)
from farpoint.operators.center_groups import CenterGroups, nearest_by_groups
from farpoint.operators.pairwise import by_task, max_pairwise_distance, n_blocks, size_and_dim
from farpoint.session import conf_int, ensure_checkpoint_dir

CHECKPOINT_EVERY = 8
# above this many coordinates in the state, unroll the distance into
# generated code (one compile per step, faster per row)
UNROLL_MIN_VALUES = 50_000_000
# from this many centers on, groups of centers with bounds beat distances to all of them
GROUPS_MIN_CENTERS = 512


def farthest_first_centers(points: DataFrame, k: int, start_id: int | None = None,
                           checkpoint_every: int | None = None,
                           seed: int | None = None) -> DataFrame:
    """D3: ``(step, id)`` of up to k centers, starting at ``start_id`` (default
    the smallest id, or with ``seed`` the seeded one-point sample X2); each
    next center is the point farthest from the chosen ones, ties to the
    smallest id.  Stops early when all remaining distances are 0
    (duplicates), so at most min(k, distinct points) centers."""
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = points.sparkSession
    if checkpoint_every is None:
        checkpoint_every = conf_int(spark, "checkpointEvery", CHECKPOINT_EVERY)
    pts = points.select("id", "v")
    schema = "step int, id long"
    if start_id is None and seed is not None:     # X2: random start, reproducible
        from farpoint.operators.sampling import random_sample
        first = random_sample(pts, 1, seed).first()
        if first is None:
            return spark.createDataFrame([], schema)
        start_id = first["id"]
    elif start_id is None:            # smallest id: one top-1, no extra scan
        first = pts.orderBy("id").limit(1).first()
        if first is None:
            return spark.createDataFrame([], schema)
        start_id = first["id"]
    else:
        first = pts.filter(F.col("id") == F.lit(start_id)).first()
        if first is None:
            raise ValueError(f"start id {start_id} not in the point set")
    picks = [(0, int(start_id))]
    vectors = [first["v"]]
    dim = len(first["v"] or [])
    state = pts.select("id", "v", dist_to_const("v", first["v"]).alias("dist")).persist()
    cached = [state]
    unroll = False
    for step in range(1, k):
        live = state.filter(~F.isnan("dist"))
        r = (live.agg(F.max_by(F.struct("id", "v", "dist"),
                               F.struct(F.col("dist"), -F.col("id"))).alias("b")).first())["b"]
        best = None if r is None else (r["id"], r["v"], r["dist"])
        while len(cached) > 1:          # the new state is materialised now
            cached.pop(0).unpersist()
        if best is None or not best[2] > 0:
            break
        picks.append((step, int(best[0])))
        vectors.append(best[1])
        if step == k - 1:
            break
        if step == 1:
            # large state: per-row speed of codegen outweighs a compile per step
            unroll = state.count() * dim >= UNROLL_MIN_VALUES
        new_d = dist_to_const("v", best[1], unroll=unroll)
        nxt = state.select("id", "v", F.least(F.col("dist"), new_d).alias("dist"))
        if checkpoint_every and step % checkpoint_every == 0:
            if fits_broadcast(len(vectors), dim):
                nxt = nearest_in_set(pts, np.array([i for _, i in picks], np.int64),
                                     np.array(vectors, np.float64), np.arange(len(picks)),
                                     with_vector=True).persist()
            else:
                ensure_checkpoint_dir(spark)
                nxt = nxt.checkpoint(eager=True)
        else:
            nxt = nxt.persist()
        cached.append(nxt)
        state = nxt
    for c in cached:
        c.unpersist()
    return spark.createDataFrame(picks, schema)


def center_points(points: DataFrame, centers: DataFrame) -> DataFrame:
    """The center rows ``(id, v, step)``; centers hold at most k ids."""
    return semi_by_ids(points.select("id", "v"), centers, extra="step")


def kcenter_max_distance(points: DataFrame, k: int, start_id: int | None = None,
                         seed: int | None = None) -> DataFrame:
    """``(max_dist)`` exact maximum distance among the k farthest-first centers.

    Requires ``1 <= k < n``; the start is as in ``farthest_first_centers``.
    """
    n = points.count()
    if not 1 <= k < n:
        raise ValueError(f"k must satisfy 1 <= k < n (k={k}, n={n})")
    centers = farthest_first_centers(points, k, start_id=start_id, seed=seed)
    return max_pairwise_distance(center_points(points, centers))


def nearest_center(points: DataFrame, centers: DataFrame) -> DataFrame:
    """``(id, center_id, dist)`` nearest center of every point; ties to the
    earlier center.  Centers (bounded by k) are broadcast to a map-only scan, many
    of them in groups that bounds can skip (``center_groups``); a center set
    beyond the broadcast limit goes through bipartite tiles."""
    cen = center_points(points, centers)
    n_cen = centers.count()                     # k rows
    head = points.select(F.size("v").alias("d")).first()    # one row, not a scan
    dim = max(0, head["d"] or 0) if head else 0
    if fits_broadcast(n_cen, dim):
        cid, cx, crank = collect_bounded(cen, extra="step")
        if n_cen >= GROUPS_MIN_CENTERS:
            return nearest_by_groups(points, CenterGroups.build(cid, cx, crank))
        return nearest_in_set(points, cid, cx, crank)
    return _nearest_tiled(points.select("id", "v"), cen, dim)


def _nearest_tiled(points: DataFrame, cen: DataFrame, dim: int) -> DataFrame:
    nl, _ = size_and_dim(points)
    nr, _ = size_and_dim(cen)
    bl, br = n_blocks(nl, dim), n_blocks(nr, dim)
    lt = points.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(bl)).cast("int").alias("a"),
                       F.lit(0).alias("side"), F.lit(None).cast("int").alias("step"))
    lt = lt.select("*", F.explode(F.sequence(F.lit(0), F.lit(br - 1))).alias("b"))
    rt = cen.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(br)).cast("int").alias("b"),
                    F.lit(1).alias("side"), F.col("step").cast("int").alias("step"))
    rt = rt.select("*", F.explode(F.sequence(F.lit(0), F.lit(bl - 1))).alias("a"))
    cols = ["a", "b", "side", "id", "v", "step"]
    tiles = by_task(lt.select(*cols).unionByName(rt.select(*cols)), bl * br,
                    F.col("a") * br + F.col("b"))

    def run(pdf):
        import pandas as pd
        side = pdf["side"].to_numpy()
        left, right = pdf[side == 0], pdf[side == 1]
        rank = right["step"].to_numpy(np.int64)
        c, d = K.nearest(K.stack(left["v"]), K.stack(right["v"]),
                         right["id"].to_numpy(np.int64), rank)
        by_id = dict(zip(right["id"].to_numpy(np.int64), rank))
        out = pd.DataFrame({"id": left["id"].to_numpy(np.int64), "center_id": c, "dist": d,
                            "step": [by_id.get(int(x), -1) for x in c]})
        return out[out["center_id"] >= 0]

    per_tile = tiles.groupBy("task").applyInPandas(
        run, "id long, center_id long, dist double, step int")
    best = per_tile.groupBy("id").agg(
        F.min_by(F.struct("center_id", "dist"), F.struct("dist", "step")).alias("b"))
    found = best.select("id", F.col("b.center_id").alias("center_id"), F.col("b.dist").alias("dist"))
    # points whose distances are all NaN keep no center
    return points.select("id").join(found, "id", "left")


def center_sizes(assignment: DataFrame) -> DataFrame:
    """``(center_id, n)`` number of points assigned to each center."""
    return assignment.groupBy("center_id").agg(F.count(F.lit(1)).alias("n"))
