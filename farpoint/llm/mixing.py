"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Slot i of the schedule has the golden-ratio point frac(i * phi); the point is
mapped through the cumulative target shares to a source.  The slots of a
source are ranked; slot rank r stands for block ``r mod n_blocks`` of that
source in pass ``r div n_blocks``.  Blocks hold ``block_words`` consecutive
words of the source's documents in hash-shuffled order, so all blocks of a
source weigh the same (the last one excepted).  The slots grow with the input and
a block keeps BLOCK_WORDS, so small sources come near their targets in tables of any
size.

Ranks and running sums are taken in two steps (inside ranges, then over their totals),
so no source passes through one task.  Blocks and pieces, as many as the words of the input, are
both shuffled and never broadcast.  The ranges of the documents are range partitions by
(source, hash, doc_id, size) and the place in the scan, so equal and null ids are spread as well.

Defined cases: null text = size 0, taken 0; null source is a source of its own,
last in order; repeated rows are separate documents; equal hashes are ordered
by doc_id, then size; an empty table gives an empty result; a table
without any word gives target 0 and taken 0.  The number of sources is taken
to fit one task (one row each).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from farpoint.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)         # of the sources in code point order, repeating
MAX_PASSES = 3              # a source is used at most this often
BLOCK_WORDS = 16
RANGE = 4096                # slots ranked together, at least (the root of their number)
SEED = "mix"                # of the shuffled order
CELLS = 4096                # cells of [0, 1) that join points to sources
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 2654435769         # 2^32 / golden ratio


def source_targets(sizes: DataFrame) -> DataFrame:
    """(src, source, source_size, target, lo, hi): targets by weight, stopped at 3 x size.

    A source is stopped when its cap by weight is below what is left over by
    weight of all sources with a larger such cap; sorted by cap / weight these
    come first, so one running sum finds the fixed point of the resharing.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Win.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in WEIGHTS])
    per = (per.withColumn("src", (F.row_number().over(order) - 1).cast("bigint"))
           .withColumn("w", w[(F.col("src") % len(WEIGHTS)).cast("int")])
           .withColumn("cap", (F.col("source_size") * MAX_PASSES).cast("double")))
    by_ratio = Win.orderBy(F.col("cap") / F.col("w"), "src")
    before = by_ratio.rowsBetween(Win.unboundedPreceding, -1)
    every = Win.partitionBy(F.lit(1))
    per = (per.withColumn("s_all", F.sum("source_size").over(every).cast("double"))
           .withColumn("w_all", F.sum("w").over(every))
           .withColumn("c_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("stopped", F.col("cap") * (F.col("w_all") - F.col("w_before"))
                       <= F.col("w") * (F.col("s_all") - F.col("c_before"))))
    free_w = F.sum(F.when(~F.col("stopped"), F.col("w"))).over(every)
    taken_c = F.coalesce(F.sum(F.when(F.col("stopped"), F.col("cap"))).over(every), F.lit(0.0))
    per = per.withColumn("target", F.when(F.col("stopped"), F.col("cap")).otherwise(
        F.col("w") * (F.col("s_all") - taken_c) / free_w))
    upto = Win.orderBy("src").rowsBetween(Win.unboundedPreceding, 0)
    t_all = F.sum("target").over(every)
    share = F.when(t_all > 0, F.sum("target").over(upto) / t_all).otherwise(F.lit(0.0))
    per = per.withColumn("hi", share)
    return (per.withColumn("lo", F.coalesce(F.lag("hi").over(Win.orderBy("src")), F.lit(0.0)))
            .select("src", "source", "source_size", "target", "lo", "hi"))


def golden_point(slot):
    """frac(slot / golden ratio) on a grid of 2^-32, shifted within the grid each 2^32 slots.

    No product passes 2^63: GOLDEN is odd, so 2^31 slots advance the point by one half.
    """
    low, half = slot.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(slot, 31).bitwiseAND(F.lit(1))
    on_grid = F.pmod(low * GOLDEN + half * (1 << 31), F.lit(1 << 32))
    turn = F.pmod(F.shiftright(slot, 32) * GOLDEN, F.lit(1 << 32))
    return (on_grid + F.shiftright(turn, 11) / (1 << 21)) / (1 << 32)


def block_schedule(sources: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, src, rank, pass, block): the schedule of the mix, one row per slot."""
    spark = sources.sparkSession
    n_slots = -(-total // block_words)
    slots_together = max(RANGE, math.isqrt(n_slots))
    cells = (sources.filter(F.col("hi") > F.col("lo"))
             .select("src", "source_size", "lo", "hi", F.explode(F.sequence(
                 F.floor(F.col("lo") * CELLS), F.ceil(F.col("hi") * CELLS) - 1)).alias("cell")))
    slots = (spark.range(n_slots).withColumnRenamed("id", "slot")
             .withColumn("point", golden_point(F.col("slot")))
             .withColumn("cell", F.floor(F.col("point") * CELLS)))
    s = (slots.join(cells, "cell")
         .filter((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
         .withColumn("range", F.floor(F.col("slot") / slots_together))
         .select("slot", "src", "source_size", "range"))
    per_range = s.groupBy("src", "range").agg(F.count(F.lit(1)).alias("n"))
    upto = Win.partitionBy("src").orderBy("range").rowsBetween(Win.unboundedPreceding, -1)
    offset = per_range.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    inside = Win.partitionBy("src", "range").orderBy("slot")
    ranked = (s.withColumn("r", F.row_number().over(inside) - 1).join(offset, ["src", "range"])
              .withColumn("rank", F.col("first") + F.col("r")))
    n_blocks = F.ceil(F.col("source_size") / block_words)
    return (ranked.withColumn("pass", F.floor(F.col("rank") / n_blocks))
            .withColumn("block", F.col("rank") % n_blocks)
            .filter(F.col("pass") < MAX_PASSES)
            .select("slot", "src", "rank", "pass", "block"))


def shuffled_positions(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``start``: the first word of the document in its source's shuffled order."""
    h = F.md5(F.concat_ws("/", F.lit(SEED), F.col("doc_id").cast("string")))
    order = ["src", "h", "doc_id", "size", "place"]
    d = scratch.save(sizes.withColumn("h", h).withColumn("place", F.monotonically_increasing_id())
                     .repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    sums = d.groupBy("src", "range").agg(F.sum("size").alias("s"))
    upto = Win.partitionBy("src").orderBy("range").rowsBetween(Win.unboundedPreceding, -1)
    first = sums.withColumn("first", F.coalesce(F.sum("s").over(upto), F.lit(0))).drop("s")
    inside = (Win.partitionBy("src", "range").orderBy("h", "doc_id", "size", "place")
              .rowsBetween(Win.unboundedPreceding, -1))
    return (d.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(first, ["src", "range"])
            .withColumn("start", F.col("first") + F.col("before"))
            .drop("h", "place", "range", "before", "first"))


def mix_sources(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words of each document in the mix."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint")
    sizes = scratch.save(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                     F.col("source").cast("string").alias("source"),
                                     size.alias("size")))
    sources = scratch.save(source_targets(sizes))
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    # each slot takes one block; the block's times are joined to the documents' pieces
    times = block_schedule(sources, total).groupBy("src", "block").agg(
        F.count(F.lit(1)).alias("times"))
    keyed = sizes.alias("d").join(sources.alias("s"),
                                  F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", F.col("d.source").alias("source"), "size", "src", "source_size", "target")
    placed = scratch.save(shuffled_positions(keyed, scratch))
    end = F.col("start") + F.col("size")
    pieces = (placed.filter(F.col("size") > 0)
              .select("src", "start", "size", F.explode(F.sequence(
                  F.floor(F.col("start") / BLOCK_WORDS),
                  F.floor((end - 1) / BLOCK_WORDS))).alias("block"))
              .withColumn("words", F.least(F.col("start") + F.col("size"),
                                           (F.col("block") + 1) * BLOCK_WORDS)
                          - F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)))
    # pieces are taken for as small as the table they are cut from: without the hint all of
    # them may pass through the driver as a broadcast
    taken = (pieces.join(times.hint("merge"), ["src", "block"])
             .groupBy("src", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    # (src, start) names one document with words; those without words take nothing
    some = placed.filter(F.col("size") > 0).join(taken, ["src", "start"], "left")
    none = placed.filter(F.col("size") == 0).withColumn("taken", F.lit(0).cast("bigint"))
    cols = ["doc_id", "source", "size", "source_size", "target",
            F.coalesce(F.col("taken"), F.lit(0)).cast("bigint").alias("taken")]
    return some.select(*cols).unionByName(none.select(*cols))
