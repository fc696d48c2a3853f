"""Blocked Bloom filter: one 64-bit block per key, four bits set in it.

Built by Spark (``bit_or`` per block), so only the filter itself, whose size is
fixed beforehand, reaches the driver and is broadcast.  False positives are
possible, misses are not; users follow it with an exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 21        # 16 MB; beyond, the filter only lets more false hits through
BITS_PER_KEY = 24


def _mask(h: Column) -> Column:
    m = F.lit(0).cast("bigint")
    for k in range(4):
        bit = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        # shiftleft by a column: Spark SQL's function takes an expression
        m = m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return m


def build(keys: DataFrame, col: str, n_keys: int) -> np.ndarray:
    """The filter of the bigint column ``col`` (already hashed) as an array of blocks."""
    n = 1 << 6
    while n * 64 < n_keys * BITS_PER_KEY and n < MAX_BLOCKS:
        n *= 2
    block = F.shiftrightunsigned(F.col(col), 24).bitwiseAND(F.lit(n - 1))
    rows = (keys.select(block.alias("b"), _mask(F.col(col)).alias("m"))
            .groupBy("b").agg(F.bit_or("m").alias("m")).toArrow())
    out = np.zeros(n, np.uint64)
    out[np.asarray(rows["b"], dtype=np.int64)] = np.asarray(rows["m"], dtype=np.int64).view(np.uint64)
    return out


def hits(blocks: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashed keys may be in the filter."""
    h = h.view(np.uint64) if h.dtype == np.int64 else h
    word = blocks[((h >> np.uint64(24)) & np.uint64(len(blocks) - 1)).astype(np.int64)]
    ok = np.ones(len(h), bool)
    for k in range(4):
        ok &= (word >> ((h >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
    return ok


def split(df: DataFrame, hashed: Column, blocks: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(rows that may be in the filter, rows that are not), by the bigint ``hashed``.

    Only the key goes to Python; so a later exact join moves only the first part.
    """
    b = df.sparkSession.sparkContext.broadcast(blocks)

    @F.arrow_udf("boolean")
    def maybe(h: pa.Array) -> pa.Array:
        ok = hits(b.value, np.asarray(h.fill_null(0), dtype=np.int64))
        return pa.array(ok & np.asarray(h.is_valid()))

    flag = maybe(hashed)
    return df.filter(flag), df.filter(~flag)
