"""Exact diameter (D1/J1) with bounding balls: tiles that cannot hold the farthest pair are never shipped.

The points are clustered into blocks (``lazy_centers.clustered``: around pivots, by
distance); every block has a ball around its own centroid.  No pair of two blocks is farther
apart than the distance of the centroids plus both radii.  The pairs of blocks are worked off from
the largest such bound down, a batch at a time; what a batch finds raises the best distance known,
and pairs of blocks whose bound is below it are dropped.  What is left is computed in tiles of two groups of
neighbouring blocks, at most ``MANY_BLOCKS`` groups while they fit a task, so a row is sent once per group and
batch and not once per block.  A block larger than ``block_rows`` is cut by a hash of the id.

How much is dropped depends on the points: clustered ones lose nearly all tiles; points spread
evenly over a sphere in many dimensions lose none, as every ball is then nearly as wide as the set.

The driver holds a centroid and a radius per block (at most PIVOTS * RINGS + 1) and their pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators import kernels as K
from farpoint.operators.bounded import max_sq_to_set
from farpoint.operators.lazy_centers import PIVOTS, RINGS, clustered
from farpoint.operators.pairwise import DEFAULT_BLOCK_BYTES, MANY_BLOCKS, MAX_BLOCK_ROWS, by_task, prune_for_diameter

MIN_BLOCK_POINTS = 512    # pivots are as many as leave this many points each, at most PIVOTS
FIRST_PAIRS = 32          # pairs of blocks of the first batch
BATCH_GROWTH = 32         # a batch sends its rows anew: few batches, the first ones small


def _balls(table: DataFrame) -> pd.DataFrame:
    """(block, n, c, r, far): rows, centroid, radius and farthest point of each block."""
    def sums(batches):
        for pdf in batches:
            for b, part in pdf.groupby("block"):
                yield pd.DataFrame({"block": [b], "n": [len(part)], "s": [K.stack(part["v"]).sum(axis=0)]})

    parts = table.select("block", "v").mapInPandas(sums, "block int, n long, s array<double>")
    rows = (parts.select("block", "n", F.posexplode("s").alias("i", "x")).groupBy("block", "i")
            .agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect())       # blocks x dimension
    center: dict[int, tuple[int, dict[int, float]]] = {}
    for r in rows:
        center.setdefault(r["block"], (r["n"], {}))[1][r["i"]] = r["x"] / r["n"]
    c = {b: np.array([x[i] for i in sorted(x)]) for b, (_, x) in center.items()}
    shared = table.sparkSession.sparkContext.broadcast(c)

    def radii(batches):
        for pdf in batches:
            for b, part in pdf.groupby("block"):
                x = K.stack(part["v"])
                d = np.sqrt(K.exact_sq(x, np.broadcast_to(shared.value[b], x.shape)))
                d = np.where(np.isnan(d), np.inf, d)
                yield pd.DataFrame({"block": [b], "r": [d.max()], "far": [x[int(np.argmax(d))]]})

    got = (table.select("block", "v").mapInPandas(radii, "block int, r double, far array<double>").groupBy("block")
           .agg(F.max_by(F.struct("r", "far"), "r").alias("b")).collect())
    return pd.DataFrame([{"block": r["block"], "n": center[r["block"]][0], "c": c[r["block"]], "r": r["b"]["r"],
                          "far": np.array(r["b"]["far"], np.float64)} for r in sorted(got, key=lambda r: r["block"])])


class _Groups:
    """The blocks, cut to ``block_rows``, put together in neighbouring groups of about ``group_rows``.

    A tile is a pair of groups.  So a row is sent at most once per group, however many
    blocks its own one is compared with.
    """

    def __init__(self, blocks: list[int], n: list[int], block_rows: int, group_rows: int):
        self.cuts = [-(-x // block_rows) for x in n]
        self.of: dict[tuple[int, int], int] = {}            # (position of the block, cut) -> group
        self.blocks, self.members, held = blocks, [], group_rows
        for i, (rows, cuts) in enumerate(zip(n, self.cuts)):
            for cut in range(cuts):
                if held + rows // cuts > group_rows:
                    self.members.append([])
                    held = 0
                held += -(-rows // cuts)
                self.of[i, cut] = len(self.members) - 1
                self.members[-1].append((i, cut))

    def sent(self, need: np.ndarray) -> tuple[list[tuple[int, int, int, list[int]]], int]:
        """(block, cuts, cut, tiles) of every cut that a tile needs, and the number of tiles."""
        number: dict[tuple[int, int], int] = {}
        in_group = [sorted({i for i, _ in m}) for m in self.members]
        touch = np.stack([need[:, x].any(axis=1) for x in in_group])        # group x block
        rows = []
        for (i, cut), g in self.of.items():
            tiles = [number.setdefault((min(g, h), max(g, h)), len(number)) for h in np.flatnonzero(touch[:, i]).tolist()]
            if tiles:
                rows.append((self.blocks[i], self.cuts[i], cut, tiles))
        return rows, len(number)


def _max_of_pairs(table: DataFrame, groups: _Groups, need: np.ndarray, best: float) -> float:
    """The largest distance over the needed pairs of blocks (a symmetric matrix), or ``best``."""
    spark = table.sparkSession
    rows, n_tiles = groups.sent(need)
    sent = spark.createDataFrame(rows, "block int, cuts int, cut int, tiles array<int>")
    at = {b: i for i, b in enumerate(groups.blocks)}
    shared = spark.sparkContext.broadcast((groups.of, at, need))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        of, at, need = shared.value
        ids, x, m = pdf["id"].to_numpy(np.int64), K.stack(pdf["v"]), best * best
        parts = {(at[b], c): rows for (b, c), rows in pdf.groupby(["block", "cut"]).indices.items()}
        group = {of[p] for p in parts}
        for p, mine in parts.items():
            if of[p] != min(group):
                continue
            # every other cut once; in a tile of two groups those of the other one
            rest = [q for q in parts if need[p[0], q[0]] and (of[q] != of[p] if len(group) == 2 else q > p)]
            xa, ia = x[mine], ids[mine]
            if len(group) == 1 and need[p[0], p[0]]:
                m = K.max_sq(xa, ia, xa, ia, triangle=True, best=m)
            if rest:
                other = np.concatenate([parts[q] for q in rest])
                m = K.max_sq(xa, ia, x[other], ids[other], triangle=False, best=m)
        return pd.DataFrame({"m2": [m]}, dtype="float64")

    keyed = table.join(F.broadcast(sent.select("block", "cuts").distinct()), "block").withColumn(
        "cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    rows = (keyed.join(F.broadcast(sent.select("block", "cut", "tiles")), ["block", "cut"])
            .select("block", "cut", "id", "v", F.explode("tiles").alias("tile")))
    tiles = by_task(rows, n_tiles, F.col("tile"))
    got = tiles.groupBy("task").applyInPandas(tile, "m2 double").agg(F.max("m2").alias("m2")).first()["m2"]
    return max(best, float(np.sqrt(got))) if got is not None else best


def max_pairwise_distance_balls(points: DataFrame, n_pivots: int | None = None, rings: int = RINGS,
                                block_rows: int = MAX_BLOCK_ROWS, counted: bool = False) -> DataFrame:
    """``(max_dist)``; ``counted`` adds ``n_tiles``, pairs of cuts compared, and ``all_tiles``, all of them.

    0.0 for fewer than two points; points with a NaN coordinate are left out, infinite
    coordinates count (their ball is infinite).
    """
    spark = points.sparkSession
    clean = points.select("id", "v").filter(~F.exists("v", lambda x: F.isnan(x)))
    best, cand = prune_for_diameter(clean)
    if n_pivots is None:
        n_pivots = max(1, min(PIVOTS, cand.count() // MIN_BLOCK_POINTS))
    table = clustered(cand, n_pivots, rings)
    balls = _balls(table)
    n_tiles = all_tiles = 0
    if len(balls):
        dim = len(balls["c"].iat[0])
        group_rows = min(max(block_rows, -(-int(balls["n"].sum()) // MANY_BLOCKS)), 4 * block_rows,
                         max(block_rows, DEFAULT_BLOCK_BYTES // max(8, 8 * dim)))
        groups = _Groups([int(b) for b in balls["block"]], [int(n) for n in balls["n"]], block_rows, group_rows)
        far = np.stack(balls["far"])
        # a good first distance: from the farthest point of every block to all points
        m2 = max_sq_to_set(table, np.arange(len(far)), far).agg(F.max("m2").alias("m2")).first()["m2"]
        best = max(best, float(np.sqrt(m2 or 0.0)))
        c, r, cuts = np.stack(balls["c"]), balls["r"].to_numpy(), np.array(groups.cuts)
        i, j = np.triu_indices(len(balls))
        with np.errstate(invalid="ignore"):
            bound = np.sqrt(K.exact_pairs(c, c, i, j)) + r[i] + r[j]
        bound = np.where(np.isnan(bound), np.inf, bound)
        bound = bound * (1 + 1e-9) + 1e-12                       # rounding: keep, never drop
        # a block with itself: any two of its points are at most two radii apart
        size = cuts[i] * cuts[j]
        all_tiles = int(size.sum())
        order = np.argsort(-bound, kind="stable")
        start, step = 0, FIRST_PAIRS
        while start < len(order):
            batch = [x for x in order[start:start + step] if bound[x] >= best]
            if not batch:
                break
            need = np.zeros((len(balls), len(balls)), bool)
            need[i[batch], j[batch]] = need[j[batch], i[batch]] = True
            best = _max_of_pairs(table, groups, need, best)
            n_tiles += int(size[batch].sum())
            start, step = start + step, step * BATCH_GROWTH
    out, schema = (float(best),), "max_dist double"
    if counted:
        out, schema = (*out, n_tiles, all_tiles), schema + ", n_tiles long, all_tiles long"
    return spark.createDataFrame([out], schema)
