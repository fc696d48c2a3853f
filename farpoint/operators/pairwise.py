"""All-pairs distance operators: D1 (exact maximum), A17 (average), and the
per-point farthest partner used by the greedy diversity round.

Plan: the point set is cut into ``B`` blocks by ``pmod(xxhash64(id), B)``;
every point is sent to the ``B`` tiles ``(min(b, c), max(b, c))`` of its block
``b`` (an ``explode`` of ``sequence(0, B-1)``, not a join), and each tile is
one ``applyInPandas`` group that holds at most two blocks.  ``B`` follows
from the row count and dimension so that a block stays under
``block_bytes``; the tiles are independent tasks, the number of tasks grows
as B^2 / 2 and the replication as B, so blocks grow before there are more than ``MANY_BLOCKS``.  Only one row per tile (maximum, sum)
or one row per point and tile (partner) leaves the Python worker; pairs are
never materialised as rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.functions.vectors import dist_to_const
from farpoint.operators import kernels as K
from farpoint.session import conf_int

DEFAULT_BLOCK_BYTES = 16 << 20
# a tile costs rows^2 distance evaluations: cap rows per block so one task
# stays around a second of numpy work whatever the dimension
MAX_BLOCK_ROWS = 8192
# every row is sent once per block: from this many blocks on (300 tiles), blocks
# grow before their number does, up to four times the rows and block_bytes
MANY_BLOCKS = 24
MAX_LARGE_BLOCK_ROWS = 4 * MAX_BLOCK_ROWS


def size_and_dim(points: DataFrame) -> tuple[int, int]:
    """Rows and dimension; vectors of different lengths are an error."""
    r = points.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("least"),
                   F.max(F.size("v")).alias("d")).first()
    if r["least"] != r["d"]:
        raise ValueError(f"points of different dimension: {r['least']} and {r['d']}")
    return int(r["n"]), int(r["d"] or 0)


def n_blocks(n: int, d: int, block_bytes: int = DEFAULT_BLOCK_BYTES) -> int:
    rows = min(MAX_LARGE_BLOCK_ROWS, max(MAX_BLOCK_ROWS, math.ceil(n / MANY_BLOCKS)))
    rows = max(256, min(rows, block_bytes // max(8, 8 * d)))
    return max(1, math.ceil(n / rows))


def _self_tiles(points: DataFrame, b: int) -> DataFrame:
    blk = F.pmod(F.xxhash64("id"), F.lit(b)).cast("int")
    df = points.select("id", "v", blk.alias("blk"))
    if b == 1:
        return df.select(F.lit(0).alias("lo"), F.lit(0).alias("hi"), "blk", "id", "v")
    df = df.select("id", "v", "blk", F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("oth"))
    return df.select(F.least("blk", "oth").alias("lo"), F.greatest("blk", "oth").alias("hi"),
                     "blk", "id", "v")


def by_task(rows: DataFrame, n: int, number) -> DataFrame:
    """Send the rows with group number i (0 <= i < n) to task i, as column ``task``.

    Tiles and parts are CPU-heavy but small in bytes: hash partitioning would
    put several on one task while others stay idle, and AQE would pack them.
    An explicit partition count is never coalesced, and a ``groupBy("task")``
    reuses this partitioning.
    """
    return rows.withColumn("task", number.cast("int")).repartitionById(max(1, n), F.col("task"))


def _by_tile(tiles: DataFrame, b: int) -> DataFrame:
    """One task per self tile (lo, hi), lo <= hi < b."""
    lo, hi = F.col("lo").cast("bigint"), F.col("hi").cast("bigint")
    return by_task(tiles, b * (b + 1) // 2, lo * b - lo * (lo - 1) / 2 + (hi - lo))


def _split_tile(pdf: pd.DataFrame):
    lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
    ids = pdf["id"].to_numpy(np.int64)
    x = K.stack(pdf["v"])
    if lo == hi:
        return True, ids, x, ids, x
    a = pdf["blk"].to_numpy() == lo
    return False, ids[a], x[a], ids[~a], x[~a]


def _tile_max(pdf: pd.DataFrame) -> pd.DataFrame:
    diag, ia, xa, ib, xb = _split_tile(pdf)
    m = K.max_sq(xa, ia, xb, ib, triangle=diag)
    return pd.DataFrame({"m2": [m]}, dtype="float64")


def _tile_sum(pdf: pd.DataFrame) -> pd.DataFrame:
    diag, ia, xa, ib, xb = _split_tile(pdf)
    s, c = K.sum_dist(xa, ia, xb, ib, triangle=diag)
    # pandas hands NaN over as NULL, which a sum would skip: flag it instead
    nan = bool(np.isnan(s))
    return pd.DataFrame({"s": [0.0 if nan else s], "c": [c], "nan": [nan]}).astype(
        {"s": "float64", "c": "int64"})


def _tile_partner(pdf: pd.DataFrame) -> pd.DataFrame:
    diag, ia, xa, ib, xb = _split_tile(pdf)
    i, p, d = K.partners(xa, ia, xb, ib, both=not diag)
    return pd.DataFrame({"id": i.astype(np.int64), "partner": p.astype(np.int64),
                         "d2": d.astype(np.float64)})


def check_pairs(points: DataFrame, n: int) -> None:
    """Refuse more pairs than ``spark.farpoint.maxPairs``, where the session sets it.

    Unset (the default), no size is refused: the exact answers are quadratic,
    and the sample-based (D2), k-center (D4) and two-round (D7) operators are
    the cheap ones.
    """
    limit = conf_int(points.sparkSession, "maxPairs", 0)
    pairs = n * (n - 1) // 2
    if limit and pairs > limit:
        raise ValueError(
            f"{pairs:.3g} pairs exceed spark.farpoint.maxPairs={limit:.3g}; use "
            "sample_max_distance / kcenter_max_distance / diversity_two_round, or raise the limit")


def _blocks_for(points: DataFrame, n_blocks_hint: int | None, block_bytes: int | None,
                min_blocks: int = 1) -> int:
    if n_blocks_hint:
        return int(n_blocks_hint)
    n, d = size_and_dim(points)
    check_pairs(points, n)
    return max(min_blocks, n_blocks(n, d, _block_bytes(points, block_bytes)))


def _block_bytes(points: DataFrame, block_bytes: int | None) -> int:
    """Explicit value, else ``spark.farpoint.blockBytes``, else 16 MB."""
    if block_bytes is not None:
        return int(block_bytes)
    return conf_int(points.sparkSession, "blockBytes", DEFAULT_BLOCK_BYTES)


def _tiled_max(points: DataFrame, n_blocks_hint: int | None, block_bytes: int) -> DataFrame:
    b = _blocks_for(points, n_blocks_hint, block_bytes)
    per_tile = _by_tile(_self_tiles(points.select("id", "v"), b), b).groupBy("task") \
        .applyInPandas(_tile_max, "m2 double")
    return per_tile.agg(F.sqrt(F.coalesce(F.max("m2"), F.lit(0.0))).alias("max_dist"))


def centroid(points: DataFrame) -> list[float] | None:
    """Coordinate-wise mean, by one sum per batch of points; None without points."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = K.stack(pdf["v"])
                yield pd.DataFrame({"s": [x.sum(axis=0)], "n": [len(x)]})

    sums = points.select("v").mapInPandas(run, "s array<double>, n long")
    total = sums.select("n", F.posexplode("s").alias("pos", "x")).groupBy("pos").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n")).collect()       # one row per dimension
    if not total:
        return None
    return [r["x"] / r["n"] for r in sorted(total, key=lambda r: r["pos"])]


def prune_for_diameter(points: DataFrame):
    """Exact candidate pruning for the farthest pair (triangle inequality).

    With ``r(p)`` the distance to the centroid, ``R = max r`` and ``LB`` the
    farthest distance from the point of largest ``r`` (a real pair distance),
    any pair farther apart than LB has both ends with ``r >= LB - R``.
    Points with an infinite coordinate always stay.
    Returns ``(LB, candidates)``; three linear scans, no pairs.
    """
    odd = F.exists("v", lambda x: F.abs(x) == F.lit(float("inf")))
    finite, infinite = points.filter(~odd), points.filter(odd).select("id", "v")
    c = centroid(finite)
    if c is None:
        return 0.0, points
    scored = finite.select("id", "v", dist_to_const("v", c).alias("r"))
    st = scored.agg(F.max_by(F.col("v"), F.struct(F.col("r"), -F.col("id"))).alias("far"),
                    F.max("r").alias("rmax")).first()
    if st["far"] is None or not np.isfinite(st["rmax"]):
        return 0.0, points
    lb = scored.agg(F.max(dist_to_const("v", st["far"])).alias("lb")).first()["lb"] or 0.0
    cut = lb - st["rmax"]
    cut -= 1e-9 * (abs(lb) + abs(st["rmax"]) + 1.0)     # rounding margin: keep, never drop
    return float(lb), scored.filter(F.col("r") >= F.lit(cut)).select("id", "v").unionByName(infinite)


def max_pairwise_distance(points: DataFrame, n_blocks_hint: int | None = None,
                          block_bytes: int | None = None,
                          prune: bool | str = "auto", min_blocks: int = 1) -> DataFrame:
    """``(max_dist)`` exact maximum Euclidean distance over all pairs.

    0.0 for fewer than two points.  Points with a NaN coordinate have only
    NaN distances, which the reference skips, so they are dropped first.
    Pruning (``prune=True``, or ``"auto"`` when the set needs more than one
    tile) runs the all-pairs tiles only over the points that can still be an
    end of the farthest pair: in low dimension a handful, in high dimension
    often all (then three linear scans were spent for nothing).
    ``min_blocks`` cuts a small set into more tiles than its size asks for.
    """
    clean = points.select("id", "v").filter(~F.exists("v", lambda x: F.isnan(x)))
    block_bytes = _block_bytes(points, block_bytes)
    n, d = size_and_dim(clean)
    if n_blocks_hint is None:
        if prune is False:
            check_pairs(points, n)
        n_blocks_hint = max(min_blocks, n_blocks(n, d, block_bytes))
    if prune is False or (prune == "auto" and n_blocks_hint == 1):
        return _tiled_max(clean, n_blocks_hint, block_bytes)
    lb, cand = prune_for_diameter(clean)
    cand = cand.persist()
    try:
        inner = _tiled_max(cand, None, block_bytes).first()["max_dist"]
    finally:
        cand.unpersist()
    spark = points.sparkSession
    return spark.createDataFrame([(float(max(lb, inner or 0.0)),)], "max_dist double")


def avg_pairwise_distance(points: DataFrame, n_blocks_hint: int | None = None,
                          block_bytes: int | None = None, min_blocks: int = 1) -> DataFrame:
    """``(avg_dist)`` mean Euclidean distance over unordered pairs.

    Equal to the reference's mean over ordered pairs; NULL for < 2 points,
    NaN when a distance is NaN, in any number of blocks.
    """
    b = _blocks_for(points, n_blocks_hint, block_bytes, min_blocks)
    per_tile = _by_tile(_self_tiles(points.select("id", "v"), b), b).groupBy("task") \
        .applyInPandas(_tile_sum, "s double, c long, nan boolean")
    agg = per_tile.agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("nan").alias("nan"))
    return agg.select(F.when(F.col("nan"), F.lit(float("nan"))).when(
        F.col("c") > 0, F.col("s") / F.col("c")).alias("avg_dist"))


def farthest_partner(points: DataFrame, n_blocks_hint: int | None = None,
                     block_bytes: int | None = None) -> DataFrame:
    """``(id, partner, d2)``: each point's farthest other point (ties: smallest id).

    Points without any partner (a one-point set) are absent.
    """
    b = _blocks_for(points, n_blocks_hint, block_bytes)
    per_tile = _by_tile(_self_tiles(points.select("id", "v"), b), b).groupBy("task") \
        .applyInPandas(_tile_partner, "id long, partner long, d2 double")
    # one block: every id is in exactly one tile, nothing to reduce
    return per_tile if b == 1 else _reduce_partner(per_tile)


def _reduce_partner(per_tile: DataFrame) -> DataFrame:
    best = per_tile.groupBy("id").agg(
        F.max_by(F.struct("partner", "d2"), F.struct(F.col("d2"), -F.col("partner"))).alias("b"))
    return best.select("id", F.col("b.partner").alias("partner"), F.col("b.d2").alias("d2"))


def _cross_tiles(left: DataFrame, right: DataFrame, bl: int, br: int) -> DataFrame:
    la = F.pmod(F.xxhash64("id"), F.lit(bl)).cast("int")
    rb = F.pmod(F.xxhash64("id"), F.lit(br)).cast("int")
    lt = left.select("id", "v", la.alias("a"), F.lit(0).alias("side"))
    if br > 1:
        lt = lt.select("*", F.explode(F.sequence(F.lit(0), F.lit(br - 1))).alias("b"))
    else:
        lt = lt.withColumn("b", F.lit(0))
    rt = right.select("id", "v", rb.alias("b"), F.lit(1).alias("side"))
    if bl > 1:
        rt = rt.select("*", F.explode(F.sequence(F.lit(0), F.lit(bl - 1))).alias("a"))
    else:
        rt = rt.withColumn("a", F.lit(0))
    cols = ["a", "b", "side", "id", "v"]
    return lt.select(*cols).unionByName(rt.select(*cols))


def _cross_partner(pdf: pd.DataFrame) -> pd.DataFrame:
    side = pdf["side"].to_numpy()
    ids = pdf["id"].to_numpy(np.int64)
    x = K.stack(pdf["v"])
    a, b = side == 0, side == 1
    i, p, d = K.best_partner(x[a], ids[a], x[b], ids[b])
    # every left row once, with its vector, partner NULL when the tile has none
    out = pd.DataFrame({"id": ids[a], "v": pdf["v"].to_numpy()[a]})
    found = pd.DataFrame({"id": i.astype(np.int64), "partner": p.astype(np.int64),
                          "d2": d.astype(np.float64)})
    return out.merge(found, on="id", how="left")[["id", "v", "partner", "d2"]]


def farthest_partner_in(left: DataFrame, right: DataFrame,
                        block_bytes: int | None = None,
                        sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """``(id, v, partner, d2)`` for every left point: its farthest right point
    with a different id (ties: smallest id; NULL when there is none).
    Bipartite tiles, no join; the left vector is carried through so callers
    can rebuild state by union instead of a join.

    ``sizes = (n_left, n_right, dim)`` (upper bounds suffice) saves the two
    counting jobs when the caller already knows them.
    """
    if sizes is None:
        nl, d = size_and_dim(left)
        nr, _ = size_and_dim(right)
    else:
        nl, nr, d = sizes
    block_bytes = _block_bytes(left, block_bytes)
    bl, br = n_blocks(nl, d, block_bytes), n_blocks(nr, d, block_bytes)
    tiles = _cross_tiles(left.select("id", "v"), right.select("id", "v"), bl, br)
    per_tile = by_task(tiles, bl * br, F.col("a") * br + F.col("b")) \
        .groupBy("task").applyInPandas(
            _cross_partner, "id long, v array<double>, partner long, d2 double")
    if br == 1:             # one right block: every left id is in exactly one tile
        return per_tile
    best = per_tile.groupBy("id").agg(
        F.first("v").alias("v"),
        F.max_by(F.struct("partner", "d2"),
                 F.struct(F.col("d2").isNotNull(), F.col("d2"), -F.col("partner"))).alias("b"))
    return best.select("id", "v", F.col("b.partner").alias("partner"), F.col("b.d2").alias("d2"))
