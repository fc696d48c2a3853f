"""Substring dedup by distributed prefix doubling: bytes covered by a repeated WIDTH-byte string.

Round 0 (GRAM bytes).  Only the minimizers of the WIDTH-byte windows are looked
at: a window is repeated only if its minimizer is (see ``runs``).  A minimizer
that occurs once retires with all its windows.  Runs of windows around equal
minimizers whose whole bytes are equal are repeated as a whole; where the runs
of one minimizer differ, one run for each distinct content goes on.

Prefix doubling.  The positions that are left (a grid of every STEP bytes,
counted from the minimizer, so that equal windows have equal grids) are ranked
by their first START bytes.  Each round pairs a position's rank with the rank
of the position ``h`` bytes on, sorts and groups the pairs, and reranks: the new
rank of a class is its least position.  Positions whose pair is unique, or
whose partner has retired, retire.  ``h`` doubles with the ranked length until
that is CORE bytes: the bytes common to STEP neighbouring windows.

Last round (WIDTH bytes).  Blocks of windows with equal ranks that are equal as
a whole are repeated; in the others each window pairs its block's rank with the
rank of the bytes that it has besides the core.

Texts are read again for each emission of positions; only ranks are shuffled.

Defined cases: null text = empty: nothing removed; rows that repeat are
documents of their own (their strings of WIDTH bytes occur elsewhere); rows
that repeat a doc_id are told apart by their text; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farpoint.llm import bloom, runs
from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

WIDTH = 200
GRAM = 100
STEP = 10                   # bytes between ranked positions = windows in a block
START = 50                  # length of the first ranks (a multiple of STEP)
CORE = WIDTH - STEP         # bytes that all windows of a block have

U = W.U
_CELL = 0x5851F42D4C957F    # any odd number below 2^55: tells the cells of a place apart


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, dtype=U).view(np.int64))


def _place(ids: np.ndarray, fp: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Fingerprint of a run's place: document and first window."""
    return W.mix(W.mix(W.mix(ids.view(U)) ^ fp.view(U)) + lo.astype(U))


def _cell(place: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Id of the position ``x`` steps after a place's minimizer."""
    return place ^ (x.astype(np.int64) * np.int64(_CELL)).view(U)


def _cell_column() -> Column:
    """``_cell`` of the columns place and x."""
    return F.col("place").bitwiseXOR(F.col("x").cast("bigint") * F.lit(_CELL))


def _int(col: pa.Array) -> np.ndarray:
    return np.asarray(col.fill_null(0), dtype=np.int64)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of all values ``first .. last`` of each index."""
    n = last - first + 1
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first[i]


def _run_pass(texts: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(ids, fps, chunk, sequence, runs) -> RecordBatch or None`` over all chunks."""
    def run(batches):
        for b in batches:
            ids, fps = _int(b.column(0)), _int(b.column(1))
            for c in W.chunks(b.column(2)):
                seq = runs.byte_sequence(c)
                r = runs.minimizer_runs(seq, WIDTH, GRAM)
                if len(r.lo):
                    out = fn(ids[c.lo:c.hi], fps[c.lo:c.hi], c, seq, r)
                    if out is not None:
                        yield out
    return texts.mapInArrow(run, schema)


def rerank(pairs: DataFrame) -> DataFrame:
    """Positions (cell, rank, next, ...) whose pair (rank, next) is not unique, with their new rank."""
    classes = (pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"), F.min("cell").alias("least"))
               .filter("n > 1").select("rank", "next", "least"))
    return pairs.join(classes, ["rank", "next"]).drop("rank", "next").withColumnRenamed("least", "rank")


def double_ranks(cells: DataFrame, scratch: Scratch, length: int, goal: int) -> DataFrame:
    """Ranks of ``goal`` bytes from the ranks of ``length`` bytes in ``cells`` (place, x, rank, ...).

    ``x`` counts the positions of a place in steps of STEP bytes.  A place has at most
    (2 WIDTH - GRAM) / STEP positions, which bounds the window that looks up the partner.
    """
    ranks = cells
    while length < goal:
        h = min(length, goal - length)
        on = Window.partitionBy("place").orderBy("x").rangeBetween(h // STEP, h // STEP)
        pairs = ranks.withColumn("next", F.max("rank").over(on)).filter("next is not null")
        done = scratch.save(rerank(pairs.withColumn("cell", _cell_column())).drop("cell"))
        if ranks is not cells:
            scratch.drop(ranks)
        ranks, length = done, length + h
    return ranks


def _once(texts: DataFrame, owners: DataFrame) -> DataFrame:
    """One row of each (doc_id, fp): rows that repeat have the same places (``owners``: k, n rows)."""
    again = owners.filter("n > 1")
    n = again.count()
    if not n:
        return texts
    some, single = bloom.split(texts, F.xxhash64("doc_id", "fp"), bloom.build(again, "k", n))
    return single.unionByName(some.groupBy("doc_id", "fp").agg(F.first("text").alias("text")))


def repeated_ranges(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, fp, start, end): byte ranges whose WIDTH-byte strings all occur elsewhere too.

    ``texts``: doc_id, fp (fingerprint of the text), text.
    """
    spark = texts.sparkSession

    def ranks(ids, fps, c, seq, r):
        return pa.RecordBatch.from_arrays([_i64(r.gram), _i64(r.span)], names=["g", "span"])

    live = scratch.save(_run_pass(texts, ranks, "g bigint, span bigint").groupBy("g").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"))
    maybe = spark.sparkContext.broadcast(bloom.build(live, "g", live.count()))

    def occurrences(ids, fps, c, seq, r):
        k = np.flatnonzero(bloom.hits(maybe.value, r.gram))
        d, o = r.doc[k], c.off[r.doc[k]]
        return pa.RecordBatch.from_arrays(
            [_i64(r.gram[k]), _i64(r.span[k]), pa.array(ids[d]), pa.array(fps[d]),
             pa.array(r.lo[k] - o), pa.array(r.hi[k] - o),
             _i64(_place(ids[d], fps[d], r.lo[k] - o))],
            names=["g", "span", "doc_id", "fp", "lo", "hi", "place"])

    occ = scratch.save(_run_pass(texts, occurrences, "g bigint, span bigint, doc_id bigint, "
                                 "fp bigint, lo bigint, hi bigint, place bigint").join(live, "g"))
    kinds = scratch.save(occ.groupBy("g", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("place")))
    whole = occ.join(kinds.filter("n > 1").select("span", "g"), ["span", "g"]).select(
        "doc_id", "fp", F.col("lo").alias("start"), (F.col("hi") + WIDTH).alias("end"))
    mixed = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n_least")
                                   ).filter("k > 1 and n_least = 1").select("g")
    open_ = scratch.save(kinds.join(mixed, "g").select("place"))
    wanted = spark.sparkContext.broadcast(bloom.build(open_, "place", open_.count()))
    # only documents with an open run are read on
    owners = scratch.save(occ.join(open_, "place").groupBy("place").agg(
        F.max(F.xxhash64("doc_id", "fp")).alias("k"), F.count(F.lit(1)).alias("n"))
        .groupBy("k").agg(F.max("n").alias("n")))
    fewer, _ = bloom.split(texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(0))),
                           F.xxhash64("doc_id", "fp"),
                           bloom.build(owners, "k", owners.count()))
    fewer = _once(fewer, owners)

    def open_runs(ids, fps, c, r):
        place = _place(ids[r.doc], fps[r.doc], r.lo - c.off[r.doc])
        return np.flatnonzero(bloom.hits(wanted.value, place)), place

    def split_blocks(r, k):
        """(index into k, block, least and largest distance of its windows to the minimizer)."""
        near, far = r.at[k] - r.hi[k], r.at[k] - r.lo[k]
        i, j = _spread(near // STEP, far // STEP)
        return i, j, np.maximum(j * STEP, near[i]), np.minimum(j * STEP + STEP - 1, far[i])

    def positions(ids, fps, c, seq, r):
        k, place = open_runs(ids, fps, c, r)
        if not len(k):
            return None
        place, near, far = place[k], r.at[k] - r.hi[k], r.at[k] - r.lo[k]
        i, x = _spread(-(far // STEP), (CORE - START) // STEP - near // STEP)
        at = r.at[k][i] + x * STEP
        rank = W.mix(seq.ranges(at, at + START) ^ W.mix(r.gram[k][i] + x.astype(U)))
        # the first position of a block of windows has the block with it
        head = x <= -(near // STEP)[i]
        a1, a2 = np.maximum(-x * STEP, near[i]), np.minimum(-x * STEP + STEP - 1, far[i])
        at = r.at[k][i]
        a1, a2 = np.where(head, a1, 0), np.where(head, a2, 0)
        span = W.mix(seq.ranges(np.where(head, at - a2, 0), np.where(head, at - a1 + WIDTH, 0))
                     ^ W.mix((a1 * WIDTH + a2).astype(U)))
        off = at - r.lo[k][i]
        return pa.RecordBatch.from_arrays(
            [_i64(place[i]), pa.array(x.astype(np.int16)), _i64(rank),
             pa.array(span.view(np.int64), mask=~head),
             pa.array((off - a2).astype(np.int16), mask=~head),
             pa.array((off - a1).astype(np.int16), mask=~head)],
            names=["place", "x", "rank", "span", "d1", "d2"])

    cells = scratch.save(_run_pass(fewer, positions, "place bigint, x smallint, rank bigint, "
                                   "span bigint, d1 smallint, d2 smallint"))
    blk = double_ranks(cells, scratch, START, CORE).filter("span is not null").withColumn(
        "cell", _cell_column())
    if START < CORE:
        scratch.drop(cells)
    sorts = scratch.save(blk.groupBy("rank", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min("cell").alias("cell")))
    some = sorts.groupBy("rank").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")
                                     ).filter("k > 1 and least = 1").select("rank")
    open_blocks = scratch.save(sorts.join(some, "rank").select("cell", "rank"))
    wanted_blocks = spark.sparkContext.broadcast(
        bloom.build(open_blocks, "cell", open_blocks.count()))

    def single_windows(ids, fps, c, seq, r):
        k, place = open_runs(ids, fps, c, r)
        if not len(k):
            return None
        i, j, a1, a2 = split_blocks(r, k)
        cell = _cell(place[k][i], -j)
        ok = bloom.hits(wanted_blocks.value, cell)
        i, j, cell, a1, a2 = i[ok], j[ok], cell[ok], a1[ok], a2[ok]
        which, dist = _spread(a1, a2)
        k = k[i][which]
        s, core = r.at[k] - dist, r.at[k] - j[which] * STEP
        # what the window has before and after the core
        edge = W.mix(seq.ranges(s, core) ^ W.mix(seq.ranges(core + CORE, s + WIDTH)
                                                 + (core - s).astype(U)))
        return pa.RecordBatch.from_arrays(
            [_i64(cell[which]), _i64(edge), _i64(place[k]), pa.array((s - r.lo[k]).astype(np.int16))],
            names=["cell", "edge", "place", "d"])

    wins = scratch.save(_run_pass(fewer, single_windows, "cell bigint, edge bigint, place bigint, d smallint")
                        .join(open_blocks, "cell").select("rank", F.col("edge").alias("next"), "place", "d"))
    again = scratch.save(wins.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select("rank", "next"))
    # windows d1 .. d2 of a run, counted from its first; at most WIDTH - GRAM + 1 of them
    equal = sorts.filter("n > 1").select("rank", "span")
    hit = (blk.join(equal, ["rank", "span"]).select("place", "d1", "d2").unionByName(
        wins.join(again, ["rank", "next"]).select(
            "place", F.col("d").alias("d1"), F.col("d").alias("d2")))
        .groupBy("place").agg(F.collect_set(F.struct("d1", "d2")).alias("ds")))
    parts = (occ.join(hit, "place").select("doc_id", "fp", "lo", F.explode("ds").alias("x"))
             .select("doc_id", "fp", (F.col("lo") + F.col("x.d1")).alias("start"),
                     (F.col("lo") + F.col("x.d2") + WIDTH).alias("end")))
    return whole.unionByName(parts)


def cut(raw: bytes, ranges) -> tuple[bytes, int, int]:
    """(kept bytes, number removed, maximal removed runs) for [{start, end}, ...]."""
    if not ranges:
        return raw, 0, 0
    a, z = runs.merge(np.array([x["start"] for x in ranges]), np.array([x["end"] for x in ranges]))
    keep = np.ones(len(raw) + 1, np.int8)
    mark = np.zeros(len(raw) + 1, np.int32)
    mark[a] += 1
    mark[z] -= 1
    keep = np.cumsum(mark[:-1]) == 0
    return np.frombuffer(raw, np.uint8)[keep].tobytes(), int((z - a).sum()), len(a)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary), one row per row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix_dedup")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("fp"), "text")
    ranges = scratch.save(
        repeated_ranges(texts, scratch).groupBy("doc_id", "fp").agg(
            F.collect_set(F.struct("start", "end")).alias("ranges"))
        .withColumn("k", F.xxhash64("doc_id", "fp"))
        .withColumnsRenamed({"doc_id": "r_id", "fp": "r_fp"}))
    scratch.keep_only(ranges)
    blocks = bloom.build(ranges, "k", ranges.count())
    # a null doc_id counts as 0 in the passes over the texts
    keyed = texts.withColumn("id0", F.coalesce("doc_id", F.lit(0)))
    maybe, clean = bloom.split(keyed, F.xxhash64("id0", "fp"), blocks)
    cols = ["doc_id", "text"]
    some = maybe.join(ranges, (F.col("id0") == F.col("r_id")) & (F.col("fp") == F.col("r_fp")),
                      "left").select(*cols, "ranges")
    none = clean.select(*cols, F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
                        .alias("ranges"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def run(batches):
        for b in batches:
            raw = [t.as_py().encode("utf-8", "surrogatepass") if t.is_valid else b""
                   for t in b.column(1)]
            out = [cut(x, r.as_py()) for x, r in zip(raw, b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in raw], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.int64()),
                 pa.array([x[0] for x in out], pa.binary())],
                names=[x.split()[0] for x in schema.split(", ")])
    return some.unionByName(none).mapInArrow(run, schema)
