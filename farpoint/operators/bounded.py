"""Broadcast of a small point set whose size is bounded by a parameter.

Samples (K points) and centers (k points) are bounded by the caller's
parameter, not by the data.  They are collected once, checked against a byte
limit, and shipped as a broadcast variable to ``mapInPandas`` tasks over the
large side, which therefore is neither shuffled nor joined.  Callers check
the size first and switch to bipartite tiles beyond these limits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.operators import kernels as K

# hard cap on what may be broadcast this way
MAX_BROADCAST_BYTES = 256 << 20
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_IDS = 4_000_000          # id-only sides: 32 MB


def fits_broadcast(n: int, dim: int) -> bool:
    """Whether n points of this dimension may be collected and broadcast."""
    return n <= MAX_BROADCAST_ROWS and n * max(1, dim) * 8 <= MAX_BROADCAST_BYTES


def collect_bounded(small: DataFrame, extra: str | None = None):
    """``(id, v[, extra])`` of a set that the caller has checked by ``fits_broadcast``."""
    cols = ["id", "v"] + ([extra] if extra else [])
    rows = small.select(*cols).collect()
    ids = np.array([r["id"] for r in rows], dtype=np.int64)
    x = np.array([r["v"] for r in rows], dtype=np.float64) if rows else np.zeros((0, 0))
    assert fits_broadcast(len(ids), x.shape[1] if x.ndim == 2 else 0)
    ex = np.array([r[extra] for r in rows], dtype=np.int64) if extra else None
    return ids, x, ex


def semi_by_ids(points: DataFrame, ids: DataFrame, extra: str | None = None) -> DataFrame:
    """Rows of ``points`` whose id is in ``ids``; broadcast only after counting ``ids``."""
    side = ids.select("id", *([extra] if extra else []))
    side = F.broadcast(side) if ids.count() <= MAX_BROADCAST_IDS else side
    return points.join(side, "id", "inner" if extra else "left_semi")


def broadcast_arrays(spark, *arrays):
    return spark.sparkContext.broadcast(tuple(arrays))


def max_sq_to_set(points: DataFrame, ids: np.ndarray, x: np.ndarray) -> DataFrame:
    """``(m2)`` per batch: largest squared distance from a point to the set."""
    spark = points.sparkSession
    bc = broadcast_arrays(spark, ids, x)

    def run(batches):
        import pandas as pd
        sid, sx = bc.value
        for pdf in batches:
            if len(pdf) == 0 or len(sid) == 0:
                continue
            m = K.max_sq(K.stack(pdf["v"]), pdf["id"].to_numpy(np.int64), sx, sid, triangle=False)
            yield pd.DataFrame({"m2": [m]}, dtype="float64")

    return points.select("id", "v").mapInPandas(run, "m2 double")


def nearest_in_set(points: DataFrame, cid: np.ndarray, cx: np.ndarray, crank: np.ndarray,
                   with_vector: bool = False) -> DataFrame:
    """``(id, center_id, dist)``: nearest center of each point (ties: lower rank).

    ``with_vector`` gives ``(id, v, dist)`` instead, the state of the
    farthest-first loop (dist NaN where there is none).
    """
    spark = points.sparkSession
    bc = broadcast_arrays(spark, cid, cx, crank)

    def run(batches):
        import pandas as pd
        ci, cxx, cr = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            c, d = K.nearest(K.stack(pdf["v"]), cxx, ci, cr)
            if with_vector:
                yield pd.DataFrame({"id": pdf["id"].to_numpy(np.int64), "v": pdf["v"],
                                    "dist": np.where(c < 0, -1.0, d)})
                continue
            out = pd.DataFrame({"id": pdf["id"].to_numpy(np.int64), "center_id": c, "dist": d})
            out.loc[out["center_id"] < 0, ["center_id", "dist"]] = [None, None]
            yield out

    if with_vector:
        state = points.select("id", "v").mapInPandas(run, "id long, v array<double>, dist double")
        return state.withColumn("dist", F.when(F.col("dist") < 0, F.lit(float("nan")))
                                .otherwise(F.col("dist")))
    return points.select("id", "v").mapInPandas(run, "id long, center_id long, dist double") \
        .withColumn("center_id", F.col("center_id").cast("long"))
