"""Class statistics over class records ``(idx bigint, class string)``.

Every count is a two-phase HashAggregate: the partial phase runs per task
before the exchange, so the shuffle carries at most (tasks x classes) rows
however skewed the classes are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.functions.keys import id_part


def _check_k(k: int) -> None:
    if int(k) < 1:
        raise ValueError("K must be >= 1")


def class_count(records: DataFrame) -> DataFrame:
    """``(class, n)`` sorted by class."""
    return (records.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("class"))


def class_histogram_by_part(records: DataFrame, k: int) -> DataFrame:
    """``(part, class, n)`` with the deterministic partition ``part = idx mod k``."""
    _check_k(k)
    return (records.groupBy(id_part("idx", k).alias("part"), "class")
            .agg(F.count(F.lit(1)).alias("n")))


def class_count_two_round(records: DataFrame, k: int) -> DataFrame:
    """A8, two rounds: per-partition histograms, then their sum per class."""
    hist = class_histogram_by_part(records, k)
    return (hist.groupBy("class").agg(F.sum("n").cast("bigint").alias("n"))
            .orderBy("class"))


def max_partition_size_deterministic(records: DataFrame, k: int) -> DataFrame:
    """``(max_partition_size)`` largest group of ``idx mod k`` (0 when empty)."""
    _check_k(k)
    sizes = records.groupBy(id_part("idx", k).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_partition_size"))


def max_partition_size_spark(records: DataFrame, k: int) -> DataFrame:
    """A10: ``(max_partition_size, n)`` largest Spark partition after ``repartition(k)``, and rows.

    Depends on the physical layout (round-robin from the input splits), so
    only bounds are stable: it lies in [ceil(n/k), n].
    """
    _check_k(k)
    parts = records.repartition(int(k)).select(F.spark_partition_id().alias("pid"))
    sizes = parts.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_partition_size"),
                     F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))


def most_frequent_class(records: DataFrame) -> DataFrame:
    """``(class, n)`` the most frequent class; ties to the smallest class.

    No row for empty input.  The final step is a top-1 over the (small)
    per-class counts, planned as TakeOrderedAndProject.
    """
    counts = records.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("class")).limit(1)
