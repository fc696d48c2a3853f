"""Partition and salt keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_part(idx: Column | str, k: int) -> Column:
    """Deterministic partition key ``idx mod k`` in ``[0, k)`` (also for negative idx)."""
    c = F.col(idx) if isinstance(idx, str) else idx
    return F.pmod(c, F.lit(int(k))).cast("int")


def hash_part(idx: Column | str, k: int) -> Column:
    """Hash partition key: balanced even for sequential or clustered ids."""
    c = F.col(idx) if isinstance(idx, str) else idx
    return F.pmod(F.xxhash64(c), F.lit(int(k))).cast("int")
