"""Coresets in more than two rounds (D5/D7 for very many parts).

Farthest-first coresets compose: a coreset of coresets is one.  Two rounds
hand k * L points to the greedy round, which is too much for it when L is in the
thousands.  The tree reduces them by parts again: round 0 takes the coreset of every part
``id mod L``, each further round merges ``fan_in`` neighbouring parts and takes the
coreset of what is left of them, until at most ``max_rows`` points (one tile of the greedy
round) or one part remain.

A group of a later round has at most fan_in * k points, whatever the input; a
part of round 0 beyond ``max_group_bytes`` goes through the lockstep plan, as in
``partition_coreset``.  Vectors travel with the coreset, so the points are
scanned once.  Every round is checkpointed: a lost executor repeats a round at most, and
the plan of a round does not contain the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators import kernels as K
from farpoint.operators.diversity import MAX_GROUP_BYTES, greedy_pairs, group_bytes, partition_coreset, with_part
from farpoint.operators.pairwise import MAX_BLOCK_ROWS
from farpoint.session import conf_int, ensure_checkpoint_dir

CORE_SCHEMA = "part int, step int, id long, v array<double>"


def _group_round(rows: DataFrame, k: int, n_parts: int) -> DataFrame:
    """Coreset ``(part, step, id, v)`` of every part, one numpy group each."""
    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        picks = K.farthest_first_chunks(K.batch_points(batches), k)
        yield pd.DataFrame({"part": np.full(len(picks), key[0], np.int32),
                            "step": np.array([s for s, _, _ in picks], np.int32),
                            "id": np.array([i for _, i, _ in picks], np.int64), "v": [v for _, _, v in picks]})

    # a task takes many small parts; an explicit count is never coalesced
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(max(1, min(n_parts, tasks)), "part").groupBy("part").applyInPandas(run, CORE_SCHEMA)


def _first_round(points: DataFrame, k: int, l_parts: int, part_key: str, max_group_bytes: int) -> DataFrame:
    parted = with_part(points, l_parts, None, part_key)
    size = (parted.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"))
            .agg(F.max("n").alias("n"), F.max("d").alias("d")).first())
    if group_bytes(size["n"] or 0, size["d"] or 0) <= max_group_bytes:
        return _group_round(parted, k, l_parts)
    # lockstep: no part is gathered; its k * L picks get their vectors by a join
    picks = partition_coreset(points, k, l_parts, part_key=part_key, plan="lockstep")
    return picks.join(points.select("id", "v"), "id").select("part", "step", "id", "v")


def coreset_tree(points: DataFrame, k: int, l_parts: int, fan_in: int | None = None,
                 max_rows: int = MAX_BLOCK_ROWS, part_key: str = "mod",
                 max_group_bytes: int | None = None) -> DataFrame:
    """``(part, step, id, v)`` of the last round: at most max(max_rows, k) points.

    ``fan_in`` parts are merged per round (default: as many as give groups of ``max_rows``
    points, at least 2).  ``part_key`` is ``"mod"`` or ``"hash"`` (see ``with_part``); ids are
    unique.  Points with a NaN distance are never picked, but a part's first point is its smallest
    id; an empty set gives no row.
    """
    if k < 1 or l_parts < 1 or max_rows < 1:
        raise ValueError("k, L and max_rows must be >= 1")
    if part_key not in ("mod", "hash"):
        raise ValueError(f"part_key {part_key!r}: parts must not depend on the layout")
    fan_in = max(2, max_rows // k) if fan_in is None else fan_in
    if fan_in < 2:
        raise ValueError("fan_in must be >= 2")
    spark = points.sparkSession
    ensure_checkpoint_dir(spark)
    if max_group_bytes is None:
        max_group_bytes = conf_int(spark, "maxGroupBytes", MAX_GROUP_BYTES)
    core = _first_round(points, k, l_parts, part_key, max_group_bytes).checkpoint(eager=True)
    n_parts = l_parts
    while n_parts > 1 and core.count() > max_rows:
        n_parts = -(-n_parts // fan_in)
        merged = core.select(F.floor(F.col("part") / fan_in).cast("int").alias("part"), "id", "v")
        core = _group_round(merged, k, n_parts).checkpoint(eager=True)
    return core


def diversity_tree(points: DataFrame, k: int, l_parts: int, **kw) -> DataFrame:
    """D7 in as many rounds as the size asks for: ``(pick, id)`` of the k chosen points."""
    core = coreset_tree(points, k, l_parts, **kw)
    return greedy_pairs(core.select("id", "v"), k, plan="coreset")
