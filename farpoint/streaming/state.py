"""Samples and part histograms as keyed state of a stream.

Both operators combine rows inside the tasks before the state's shuffle, keep a
state whose size a parameter or the number of classes bounds, and emit facts that
only ever move one way: a row that entered a sample, a count that grew.  So any
append sink will do, rows delivered twice change nothing, and the result is one
small aggregate over what was emitted.

The state needs the RocksDB provider (``ROCKSDB``) and, on a cluster, a checkpoint
location in a shared folder; a query that is started again on its checkpoint goes on
where it ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from farpoint.functions.keys import id_part
from farpoint.operators.sampling import random_sample, sample_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _check_provider(stream: DataFrame) -> None:
    if "RocksDB" not in stream.sparkSession.conf.get(PROVIDER, ""):
        raise ValueError(f"keyed state needs the session setting {PROVIDER}={ROCKSDB}")


# ---- X1: seeded sample -----------------------------------------------------

def _least(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    return rows.sort_values(["_h", "id"], kind="stable").head(k)


class _BottomK(StatefulProcessor):
    """Keeps the k least (_h, id) of its lane and passes on the rows that enter."""

    def __init__(self, k: int, columns: list[str]):
        self.k = k
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "h string, id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = {(h, int(i)) for h, i in self.kept.get()}
        before, entered = set(kept), None
        for pdf in rows:
            # names that no Python field may have (_h) arrive changed
            pdf = pdf.set_axis(self.columns, axis=1).drop_duplicates("id")
            new = [p not in kept for p in zip(pdf["_h"], pdf["id"])]
            entered = _least(pd.concat([entered, pdf[new]]), self.k)
            kept = set(sorted(before.union(zip(entered["_h"], map(int, entered["id"]))))[:self.k])
        if kept != before:
            self.kept.put(sorted(kept))
            yield entered[[p in kept for p in zip(entered["_h"], entered["id"])]]

    def close(self) -> None:
        pass


def stream_sample(points: DataFrame, k: int, seed: int, lanes: int = 16) -> DataFrame:
    """X1 on a stream: the rows of ``points`` that entered the least k of their lane, with ``lane``.

    ``current_sample`` over everything emitted is the sample of all rows so far.  A row
    that leaves a lane's least k never comes back, so what was emitted always holds the
    whole sample; of n rows about ``k * (1 + ln(n / (k * lanes)))`` a lane are emitted.  Each Arrow
    batch hands on its own least k rows only, and the state is k keys a lane, not rows.
    ``id`` is unique and not null; a row whose id is kept already is not taken again.
    Write it in ``append`` mode.
    """
    if k < 1 or lanes < 1:
        raise ValueError("k and lanes must be >= 1")
    _check_provider(points)
    keyed = points.select("*", sample_key(seed).alias("_h"))

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _least(pdf.drop_duplicates("id"), k)

    few = keyed.mapInPandas(least, keyed.schema)
    lane = F.pmod(F.xxhash64("id"), F.lit(int(lanes))).cast("int").alias("lane")
    laned = few.select("*", lane)
    return (laned.groupBy("lane")
            .transformWithStateInPandas(_BottomK(int(k), laned.columns), laned.schema, "append", "none")
            .drop("_h"))


def current_sample(emitted: DataFrame, k: int, seed: int) -> DataFrame:
    """The sample of ``min(k, n)`` rows from what ``stream_sample`` (same k and seed) emitted."""
    return random_sample(emitted.drop("lane").dropDuplicates(["id"]), k, seed)


# ---- A8a, A10a: histogram and size of each part ----------------------------

class _PartCounts(StatefulProcessor):
    """Rows per class of one part; emits what grew, at once or when the part's timer ends."""

    def __init__(self, every_ms: int):
        self.every_ms = every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "class string", "n long")
        self.size = handle.getValueState("size", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        grown: dict[str, int] = {}
        for pdf in rows:
            for _, cls, n in pdf.itertuples(index=False, name=None):     # part, class, n
                grown[cls] = grown.get(cls, 0) + int(n)
        size = (self.size.get()[0] if self.size.exists() else 0) + sum(grown.values())
        self.size.update((size,))
        for cls, n in grown.items():
            old = self.counts.getValue((cls,))[0] if self.counts.containsKey((cls,)) else 0
            grown[cls] = old + n
            self.counts.updateValue((cls,), (old + n,))
        if not self.every_ms:
            yield self._rows(key, grown.items(), size)
        elif not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        counts = [(k[0], v[0]) for k, v in self.counts.iterator()]
        yield self._rows(key, counts, self.size.get()[0])

    @staticmethod
    def _rows(key, counts, size: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], c, n, size) for c, n in counts],
                            columns=["part", "class", "n", "part_size"])

    def close(self) -> None:
        pass


def stream_class_histogram(records: DataFrame, k: int, every_ms: int = 0) -> DataFrame:
    """A8a/A10a on a stream: ``(part, class, n, part_size)`` whenever counts of a part grew.

    ``every_ms = 0`` emits the classes that a micro-batch changed.  Otherwise a part emits
    its whole histogram that long after its first change, by a processing-time timer.
    ``histogram_so_far`` and ``largest_part_so_far`` give the results.  Records are counted
    per Arrow batch before the shuffle, so a hot part ships one row a class and batch.
    Parts follow ``idx mod k``; null classes are not allowed.  Write it in ``append`` mode.
    """
    if k < 1 or every_ms < 0:
        raise ValueError("k must be >= 1 and every_ms >= 0")
    _check_provider(records)
    parted = records.select(id_part("idx", k).alias("part"), "class")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.groupby(["part", "class"]).size().reset_index(name="n")

    part_type = parted.schema["part"].dataType.simpleString()
    counted = parted.mapInPandas(count, f"part {part_type}, class string, n long")
    out = StructType.fromDDL(f"part {part_type}, class string, n long, part_size long")
    return counted.groupBy("part").transformWithStateInPandas(
        _PartCounts(int(every_ms)), out, "append", "processingTime" if every_ms else "none")


def histogram_so_far(emitted: DataFrame) -> DataFrame:
    """``(part, class, n)`` from what ``stream_class_histogram`` emitted: counts only grow."""
    return emitted.groupBy("part", "class").agg(F.max("n").alias("n"))


def largest_part_so_far(emitted: DataFrame) -> DataFrame:
    """``(max_partition_size)`` from what ``stream_class_histogram`` emitted (0 when nothing was)."""
    return emitted.agg(F.coalesce(F.max("part_size"), F.lit(0)).cast("bigint")
                       .alias("max_partition_size"))
