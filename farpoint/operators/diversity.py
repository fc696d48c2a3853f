"""Two-round diversity maximisation: per-part farthest-first coresets (D5),
greedy farthest pairs on the coreset (D6), end to end (D7), and the score
(D8, mean pairwise distance of the solution).

D5 has two exact plans with the same result:

* group plan -- ``groupBy(part).applyInPandas``: one Python task runs the
  farthest-first traversal of one part in numpy, which it reads batch by batch
  into compact arrays (``group_bytes``).  Used only when the largest
  part (one ``groupBy(part).count()``, L rows) fits ``max_group_bytes``.
* lockstep plan -- all parts advance together, one Spark step per center:
  a ``groupBy(part)`` ``max_by`` picks every part's farthest point (L rows),
  which go back by broadcast hash join on ``part`` (L rows, size checked)
  to update the distance column.  No part is ever gathered in one task, so
  a part holding a third of all rows is fine.

D6 has three exact plans with the same picks:

* group plan -- a set of at most one tile's rows (a coreset is bounded by
  k * L) runs the greedy in one numpy group;
* step plan -- every unused point keeps its farthest unused partner (tiled
  all-pairs once); a step takes the best pair (one aggregate), drops both
  points and recomputes the partner only of points whose partner was
  dropped (bipartite tiles);
* rounds plan -- all mutual-best pairs per round, stopping once the k/2
  best kept pairs cannot be beaten.

Ties everywhere go to the smallest ids, and all plans sum a distance's
coordinates in the same order, so the picks equal the sequential greedy's.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farpoint.functions.keys import hash_part, id_part
from farpoint.functions.vectors import euclidean
from farpoint.operators import kernels as K
from farpoint.operators.bounded import semi_by_ids
from farpoint.operators.pairwise import (
    MAX_BLOCK_ROWS,
    avg_pairwise_distance,
    by_task,
    farthest_partner,
    farthest_partner_in,
    size_and_dim,
)
from farpoint.session import conf_int, ensure_checkpoint_dir

MAX_GROUP_BYTES = 512 << 20
# the greedy round holds its whole (parameter-bounded) input in one group
# only below this size; above it the distributed step plan runs
MAX_GREEDY_GROUP_BYTES = 64 << 20
MAX_BROADCAST_PARTS = 100_000
# centers of one lockstep step that may pass through the driver
MAX_LOCKSTEP_BYTES = 64 << 20
CHECKPOINT_EVERY = 8
# a greedy step refers to the previous state three times (kept rows, stale
# rows, live set), so its plan would double per step: cut it every step
GREEDY_CHECKPOINT_EVERY = 1
# from this dimension on, the rounds plan beats the step plan
ROUNDS_MIN_DIM = 8


def with_part(points: DataFrame, l_parts: int, part_col: str | None = None,
              part_key: str = "mod") -> DataFrame:
    """``(part, id, v)``.

    The part is ``part_col`` when given, else ``id mod L`` (``part_key="mod"``:
    reproducible and what the SQL oracle uses, balanced for dense ids),
    ``xxhash64(id) mod L`` (``"hash"``: balanced for sequential or clustered
    ids) or the Spark partition after ``repartition(L)`` (``"spark"``).
    """
    if l_parts < 1:
        raise ValueError("L must be >= 1")
    if part_col:
        part = F.col(part_col).cast("int")
    elif part_key == "hash":
        part = hash_part("id", l_parts)
    elif part_key == "mod":
        part = id_part("id", l_parts)
    elif part_key == "spark":
        # the Spark partitions of repartition(L), as the reference's round 1
        # uses; layout-dependent, but stable for a given input (round-robin
        # repartitioning sorts rows first, so retries reproduce it)
        spread = points.select("id", "v").repartition(int(l_parts))
        return spread.select(F.spark_partition_id().alias("part"), "id", "v")
    else:
        raise ValueError(f"unknown part_key {part_key!r}")
    return points.select(part.alias("part"), "id", "v")


def group_bytes(n: int, dim: int) -> int:
    """What the group plan holds of a part of n points: ids, coordinates and distances."""
    return n * 8 * (max(1, dim) + 2)


def _coreset_group_plan(parted: DataFrame, k: int, l_parts: int, numbered: bool) -> DataFrame:
    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        picks = K.farthest_first_chunks(K.batch_points(batches), k)
        yield pd.DataFrame({"part": [int(key[0])] * len(picks),
                            "step": [s for s, _, _ in picks],
                            "id": [i for _, i, _ in picks]}).astype(
            {"part": "int32", "step": "int32", "id": "int64"})

    if numbered:                # parts 0 .. L-1: one task each
        return by_task(parted, l_parts, F.col("part")).groupBy("task") \
            .applyInPandas(run, "part int, step int, id long")
    # user parts have any numbers: spread by hash; an explicit count is never coalesced
    n_parts = max(int(l_parts), parted.sparkSession.sparkContext.defaultParallelism)
    return parted.repartition(n_parts, "part").groupBy("part") \
        .applyInPandas(run, "part int, step int, id long")


def _coreset_lockstep_plan(parted: DataFrame, k: int, checkpoint_every: int) -> DataFrame:
    spark = parted.sparkSession
    schema = "part int, id long, cv array<double>"

    first_df = (parted.groupBy("part")
                .agg(F.min_by(F.struct("id", "v"), F.col("id")).alias("b"))
                .select("part", F.col("b.id").alias("id"), F.col("b.v").alias("cv")))
    size = first_df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cv")).alias("d")).first()
    if size["n"] > MAX_BROADCAST_PARTS or size["n"] * 8 * max(1, size["d"] or 0) > MAX_LOCKSTEP_BYTES:
        return _coreset_lockstep_shuffled(parted, first_df, k)

    def local(rows):            # L rows per step (one new center per part), checked above
        return spark.createDataFrame([(r["part"], r["id"], r["cv"]) for r in rows], schema)

    first = first_df.collect()
    picks = [(r["part"], 0, r["id"]) for r in first]
    centers = local(first)
    state = (parted.join(F.broadcast(centers.select("part", "cv")), "part")
             .select("part", "id", "v", euclidean("v", "cv").alias("dist")).persist())
    cached = [state]
    for step in range(1, k):
        best = (state.filter(~F.isnan("dist"))
                .groupBy("part")
                .agg(F.max_by(F.struct("id", "v"), F.struct(F.col("dist"), -F.col("id"))).alias("b"),
                     F.max("dist").alias("m"))
                .filter(F.col("m") > 0)
                .select("part", F.col("b.id").alias("id"), F.col("b.v").alias("cv"))
                .collect())
        while len(cached) > 1:          # the current state is materialised now
            cached.pop(0).unpersist()
        if not best:
            break
        picks += [(r["part"], step, r["id"]) for r in best]
        if step == k - 1:
            break
        # the new centers are a leaf: each step's plan refers to the state once
        nxt = (state.join(F.broadcast(local(best).select("part", "cv")), "part", "left")
               .select("part", "id", "v",
                       F.when(F.col("cv").isNull(), F.col("dist"))
                        .otherwise(F.least(F.col("dist"), euclidean("v", "cv"))).alias("dist")))
        if checkpoint_every and step % checkpoint_every == 0:
            ensure_checkpoint_dir(spark)
            nxt = nxt.checkpoint(eager=True)
        else:
            nxt = nxt.persist()
        cached.append(nxt)
        state = nxt
    for c in cached:
        c.unpersist()
    return spark.createDataFrame(picks, "part int, step int, id long")


def _coreset_lockstep_shuffled(parted: DataFrame, first_df: DataFrame, k: int) -> DataFrame:
    """Lockstep plan for more parts than can be collected: the per-step
    centers stay DataFrames, joined on ``part`` (shuffled; AQE splits skewed
    parts) and checkpointed each step so plans and statistics stay small."""
    spark = parted.sparkSession
    ensure_checkpoint_dir(spark)
    centers = first_df.checkpoint(eager=True)
    picks = [centers.select("part", F.lit(0).alias("step"), "id")]
    state = (parted.join(centers.select("part", "cv"), "part")
             .select("part", "id", "v", euclidean("v", "cv").alias("dist")).checkpoint(eager=True))
    for step in range(1, k):
        best = (state.filter(~F.isnan("dist"))
                .groupBy("part")
                .agg(F.max_by(F.struct("id", "v"), F.struct(F.col("dist"), -F.col("id"))).alias("b"),
                     F.max("dist").alias("m"))
                .filter(F.col("m") > 0)
                .select("part", F.col("b.id").alias("id"), F.col("b.v").alias("cv"))
                .checkpoint(eager=True))
        if best.isEmpty():
            break
        picks.append(best.select("part", F.lit(step).alias("step"), "id"))
        if step == k - 1:
            break
        state = (state.join(best.select("part", "cv"), "part", "left")
                 .select("part", "id", "v",
                         F.when(F.col("cv").isNull(), F.col("dist"))
                          .otherwise(F.least(F.col("dist"), euclidean("v", "cv"))).alias("dist"))
                 .checkpoint(eager=True))
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    return out.select(F.col("part").cast("int"), F.col("step").cast("int"), F.col("id").cast("long"))


def partition_coreset(points: DataFrame, k: int, l_parts: int, part_col: str | None = None,
                      max_group_bytes: int | None = None,
                      checkpoint_every: int | None = None,
                      plan: str = "auto", part_key: str = "mod") -> DataFrame:
    """``(part, step, id)`` farthest-first centers of every part (at most k each).

    Limits default to the session settings ``spark.farpoint.maxGroupBytes``
    and ``spark.farpoint.checkpointEvery`` (512 MB, 8).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = points.sparkSession
    if max_group_bytes is None:
        max_group_bytes = conf_int(spark, "maxGroupBytes", MAX_GROUP_BYTES)
    if checkpoint_every is None:
        checkpoint_every = conf_int(spark, "checkpointEvery", CHECKPOINT_EVERY)
    parted = with_part(points, l_parts, part_col, part_key)
    if plan == "auto":
        stats = (parted.groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                             F.max(F.size("v")).alias("d"))
                 .agg(F.max("n").alias("n"), F.max("d").alias("d")).first())
        biggest = group_bytes(int(stats["n"] or 0), int(stats["d"] or 0))
        plan = "group" if biggest <= max_group_bytes else "lockstep"
    if plan == "group":
        return _coreset_group_plan(parted, k, l_parts, part_col is None)
    return _coreset_lockstep_plan(parted, k, checkpoint_every)


def coreset_points(points: DataFrame, coreset: DataFrame) -> DataFrame:
    """Coreset rows with their vectors ``(id, v)``.

    The coreset has at most k ids per part.  It is checkpointed and counted;
    within the broadcast limit (always, for ``id mod L`` parts) its ids are
    broadcast, so the semi join is map-only and the points are not shuffled.
    A coreset over a user part column with very many parts falls back to a
    shuffled semi join.
    """
    ensure_checkpoint_dir(points.sparkSession)
    return semi_by_ids(points.select("id", "v"), coreset.select("id").checkpoint(eager=True))


def _greedy_group_plan(pts: DataFrame, k: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        picks = K.greedy_pairs(pdf["id"].to_numpy(np.int64), K.stack(pdf["v"]), k)
        return pd.DataFrame({"pick": np.arange(1, len(picks) + 1, dtype=np.int32),
                             "id": np.array(picks, dtype=np.int64)})

    return pts.select(F.lit(0).alias("g"), "id", "v").groupBy("g") \
        .applyInPandas(run, "pick int, id long")


def _n_stale(stale: DataFrame, n_alive: int) -> int:
    """Rows to recompute: the live rows are sent once per block of them.  A set of one block needs no count."""
    return stale.count() if n_alive > MAX_BLOCK_ROWS else n_alive


def _greedy_rounds_plan(pts: DataFrame, n: int, dim: int, k: int) -> list[int]:
    """Greedy picks by rounds of locally dominant pairs (exact).

    A pair that is the farthest pair of both its ends is in the greedy
    matching, and the greedy's first k/2 picks are that matching's k/2
    heaviest pairs.  Each round matches every mutual pair, keeps the k/2
    best matched pairs seen (driver, bounded by k), and recomputes partners
    only for points whose partner was matched.  It stops once the k/2-th
    kept pair is strictly heavier than any remaining point's partner, so no
    later pair can rank above it.  Needs far fewer rounds than k/2 steps.
    """
    spark = pts.sparkSession
    half = k // 2
    if half == 0:
        return []
    lo, hi = F.least("id", "partner"), F.greatest("id", "partner")
    ensure_checkpoint_dir(spark)
    state = pts.join(farthest_partner(pts), "id", "left") \
        .select("id", "v", "partner", "d2").checkpoint(eager=True)
    found: list[tuple[float, int, int]] = []
    n_alive = n
    while n_alive >= 2:
        marked = state.withColumn(
            "mutual", F.col("partner").isNotNull()
            & (F.count(F.lit(1)).over(Window.partitionBy(lo, hi)) == 2)).persist()
        new = (marked.filter(F.col("mutual") & (F.col("id") < F.col("partner")))
               .orderBy(F.desc("d2"), F.asc("id"), F.asc("partner")).limit(half)
               .select("d2", "id", "partner").collect())
        found = sorted(found + [(r["d2"], r["id"], r["partner"]) for r in new],
                       key=lambda x: (-x[0], x[1], x[2]))[:half]
        if not new:             # only points without any partner are left (NaN)
            marked.unpersist()
            break
        rest = marked.filter(~F.col("mutual")).drop("mutual")
        st = rest.agg(F.max("d2").alias("w"), F.count(F.lit(1)).alias("n")).first()
        n_alive = st["n"]
        if len(found) == half and (st["w"] is None or found[-1][0] > st["w"]):
            marked.unpersist()
            break
        matched = marked.filter("mutual").select(F.col("id").alias("partner"))
        stale = rest.join(matched, "partner", "left_semi").select("id", "v")
        fresh = rest.join(matched, "partner", "left_anti")
        redo = farthest_partner_in(stale, rest.select("id", "v"), sizes=(_n_stale(stale, n_alive), n_alive, dim))
        nxt = fresh.select("id", "v", "partner", "d2").unionByName(redo).checkpoint(eager=True)
        marked.unpersist()
        state = nxt
    return [x for _, i, j in found for x in (int(i), int(j))]


def choose_greedy_plan(n: int, dim: int, max_group_bytes: int = MAX_GREEDY_GROUP_BYTES) -> str:
    """Plan for the greedy round of an n-point, dim-dimensional set.

    One group does O(n^2) work on one core: only up to one tile's rows.
    Beyond that, rounds of mutual pairs win in high dimension, where
    farthest partners spread out (measured on a 1600-point, 64-d coreset,
    k = 100: 3.6 s against 19.7 s for steps); in low dimension they pile
    onto a few hull points, so rounds match few pairs each and the step
    plan is faster (2-d: 22.8 s against 28.5 s).
    """
    if n <= MAX_BLOCK_ROWS and n * max(1, dim) * 8 <= max_group_bytes:
        return "group"
    return "rounds" if dim >= ROUNDS_MIN_DIM else "steps"


def greedy_pairs(core: DataFrame, k: int, checkpoint_every: int = GREEDY_CHECKPOINT_EVERY,
                 plan: str = "auto", max_group_bytes: int | None = None) -> DataFrame:
    """``(pick, id)`` -- k/2 times the farthest pair of unused points
    (ties: smallest i, then j, i < j), then the smallest unused ids up to
    min(k, n) (one for odd k, more where NaN points leave no pair).
    When k >= n all points are returned in id order.

    ``plan="auto"`` uses rounds of locally dominant pairs in high dimension
    and the step plan (k/2 steps) in low dimension.  ``plan="coreset"`` is for
    a set whose size parameters bound (k * L points): it takes one numpy group
    while that fits one tile's rows and ``max_group_bytes``, and else the
    plans of ``auto`` (``choose_greedy_plan``).  All plans give the same picks.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = core.sparkSession
    if max_group_bytes is None:
        max_group_bytes = conf_int(spark, "maxGreedyGroupBytes", MAX_GREEDY_GROUP_BYTES)
    pts = core.select("id", "v").persist()
    n, dim = size_and_dim(pts)
    schema = "pick int, id long"
    if plan in ("auto", "coreset"):
        plan = choose_greedy_plan(n, dim, max_group_bytes if plan == "coreset" else 0)
    if plan == "group":
        rows = _greedy_group_plan(pts, k).collect()         # k rows
        pts.unpersist()
        return spark.createDataFrame([(r["pick"], r["id"]) for r in rows], schema)
    if k >= n:
        ids = [r["id"] for r in pts.select("id").orderBy("id").collect()]  # n <= k rows
        pts.unpersist()
        return spark.createDataFrame([(i + 1, int(x)) for i, x in enumerate(ids)], schema)
    if plan == "rounds":
        picks = _fill(pts, _greedy_rounds_plan(pts, n, dim, k), k)
        pts.unpersist()
        return spark.createDataFrame([(i + 1, x) for i, x in enumerate(picks)], schema)
    state = pts.join(farthest_partner(pts), "id", "left") \
        .select("id", "v", "partner", "d2").persist()
    cached, picks = [pts, state], []
    lo = F.least("id", "partner")
    hi = F.greatest("id", "partner")
    for t in range(k // 2):
        top = (state.filter(F.col("partner").isNotNull())
               .agg(F.max(F.struct(F.col("d2"), -lo, -hi)).alias("b")).first()["b"])
        if top is None:
            break
        i, j = -top[1], -top[2]
        picks += [int(i), int(j)]
        rest = state.filter(~F.col("id").isin(i, j))
        hit = F.col("partner").isin(i, j)
        if t == k // 2 - 1:
            state = rest.persist()
            cached.append(state)
            break
        alive = rest.select("id", "v")
        stale = rest.filter(hit).select("id", "v")
        fresh = rest.filter(~hit | F.col("partner").isNull())
        n_alive = n - 2 * (t + 1)
        redo = farthest_partner_in(stale, alive, sizes=(_n_stale(stale, n_alive), n_alive, dim))
        nxt = fresh.select("id", "v", "partner", "d2").unionByName(redo)
        if checkpoint_every and (t + 1) % checkpoint_every == 0:
            ensure_checkpoint_dir(spark)
            nxt = nxt.checkpoint(eager=True)
        else:
            nxt = nxt.persist()
        cached.append(nxt)
        state = nxt
        while len(cached) > 4:          # keep pts, the partner table and the last two states
            cached.pop(2).unpersist()
    picks = _fill(pts, picks, k)
    for c in cached:
        c.unpersist()
    return spark.createDataFrame([(i + 1, x) for i, x in enumerate(picks)], schema)


def _fill(pts: DataFrame, picks: list[int], k: int) -> list[int]:
    """The picks and the smallest unused ids, k in all (or every id there is)."""
    if len(picks) == k:
        return picks
    rest = (pts.filter(~F.col("id").isin(picks)) if picks else pts).select("id")
    return picks + [int(r["id"]) for r in rest.orderBy("id").limit(k - len(picks)).collect()]


def diversity_two_round(points: DataFrame, k: int, l_parts: int, part_col: str | None = None,
                        **kw) -> DataFrame:
    """``(pick, id)`` the k points chosen by coreset round + greedy round."""
    coreset = partition_coreset(points, k, l_parts, part_col, **kw)
    return greedy_pairs(coreset_points(points, coreset), k, plan="coreset")


def diversity_score(points: DataFrame, solution: DataFrame) -> DataFrame:
    """``(avg_dist)`` mean pairwise distance of the solution points."""
    return avg_pairwise_distance(semi_by_ids(points.select("id", "v"), solution))
