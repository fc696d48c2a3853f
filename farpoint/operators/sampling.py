"""Seeded sampling (X1), sample complement (J6), and the sample-based
2-approximation of the maximum pairwise distance (D2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators.bounded import (
    MAX_BROADCAST_IDS,
    collect_bounded,
    fits_broadcast,
    max_sq_to_set,
)
from farpoint.operators.pairwise import farthest_partner_in
from farpoint.session import ensure_checkpoint_dir


def sample_key(seed: int) -> F.Column:
    """Order key of the seeded sample: ``md5("<seed>:<id>")``, then id."""
    return F.md5(F.concat_ws(":", F.lit(str(int(seed))), F.col("id").cast("string")))


def random_sample(points: DataFrame, k: int, seed: int) -> DataFrame:
    """Exactly ``min(k, n)`` points, the same on any cluster layout.

    A top-k by hash (TakeOrderedAndProject): every task keeps at most k rows,
    so nothing but k rows per task crosses the exchange.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    return (points.select("*", sample_key(seed).alias("_h"))
            .orderBy("_h", "id").limit(int(k)).drop("_h"))


def sample_complement(points: DataFrame, sample: DataFrame) -> DataFrame:
    """Points whose id is not in the sample (left anti join).

    The sample holds at most k ids (a parameter); it is counted and, within
    the broadcast limit, broadcast so the anti join is map-only; a larger
    sample takes a shuffled anti join.
    """
    ids = sample.select("id")
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return points.join(ids, "id", "left_anti")


def sample_max_distance(points: DataFrame, k: int, seed: int) -> DataFrame:
    """``(max_dist)`` largest distance between a sampled and a non-sampled point.

    Requires ``1 <= k < n``.  The k sampled points are broadcast (size
    checked) to a ``mapInPandas`` scan of the rest: no shuffle of the points.
    A sample beyond the broadcast limit goes through bipartite tiles instead.
    """
    pts = points.select("id", "v")
    n = pts.count()
    if not 1 <= k < n:
        raise ValueError(f"k must satisfy 1 <= k < n (k={k}, n={n})")
    sample = random_sample(pts, k, seed)
    head = pts.select(F.size("v").alias("d")).first()     # one row, not a scan
    dim = max(0, head["d"] or 0) if head else 0
    if fits_broadcast(k, dim):
        sid, sx, _ = collect_bounded(sample)
        ids = pts.sparkSession.createDataFrame([(int(i),) for i in sid], "id long")
        rest = pts.join(F.broadcast(ids), "id", "left_anti")       # k ids, checked above
        per_batch = max_sq_to_set(rest, sid, sx)
        return per_batch.agg(F.sqrt(F.coalesce(F.max("m2"), F.lit(0.0))).alias("max_dist"))
    # too large to broadcast: shuffled anti join and bipartite tiles, no collect
    ensure_checkpoint_dir(pts.sparkSession)
    sample = sample.checkpoint(eager=True)
    rest = pts.join(sample.select("id"), "id", "left_anti")
    best = farthest_partner_in(rest, sample, sizes=(n - k, k, dim))
    return best.agg(F.sqrt(F.coalesce(F.max("d2"), F.lit(0.0))).alias("max_dist"))
