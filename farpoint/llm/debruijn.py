"""Substring dedup by De Bruijn compaction: words of repeated WIDTH-word windows.

Nodes are token k-mers (GRAM words), an edge leads from one node of a document
to the next.  Only the minimizer k-mers of the WIDTH-word windows are nodes: a
window is repeated only if its minimizer is (see ``runs``), so the graph keeps
about one word in ten.  K-mers that occur once drop out.

A node is nonbranching when all its occurrences have the same context (all
windows around it, and the same next node at the same distance).  Nonbranching
nodes with one predecessor compact into paths by pointer doubling over Spark
joins; every document that visits a path walks it as a whole, so its visits
are read off as source spans (first to last word covered) instead of single
nodes.  Where contexts differ (branching nodes) the source coordinates verify:
the windows of each distinct context are compared themselves.

Defined cases: null text or no words: nothing removed; rows that repeat are
documents of their own; rows that repeat a doc_id are told apart by their text;
an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.llm import bloom, runs
from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

WIDTH = 35
GRAM = 17

U = W.U


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, dtype=U).view(np.int64))


def _place(ids: np.ndarray, fp: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Fingerprint of an occurrence: document and first window."""
    return W.mix(W.mix(W.mix(ids.view(U)) ^ fp.view(U)) + lo.astype(U))


def _int(col: pa.Array) -> np.ndarray:
    return np.asarray(col.fill_null(0), dtype=np.int64)


def _run_pass(texts: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(ids, fps, words, sequence, runs) -> RecordBatch or None`` over all chunks."""
    def run(batches):
        for b in batches:
            ids, fps = _int(b.column(0)), _int(b.column(1))
            for c in W.chunks(b.column(2)):
                w = W.words(c)
                seq = runs.word_sequence(w)
                r = runs.minimizer_runs(seq, WIDTH, GRAM)
                if len(r.lo):
                    out = fn(ids[c.lo:c.hi], fps[c.lo:c.hi], w, seq, r)
                    if out is not None:
                        yield out
    return texts.mapInArrow(run, schema)


def _next(r: runs.Runs) -> tuple[np.ndarray, np.ndarray]:
    """(next node of the document, words to it); no next node: 0 and -1."""
    last = np.append(r.doc[1:] != r.doc[:-1], True)
    return (np.where(last, U(0), np.append(r.gram[1:], U(0))),
            np.where(last, -1, np.append(r.at[1:] - r.at[:-1], -1)))


def context(r: runs.Runs) -> np.ndarray:
    """Fingerprint of a node's context: its windows, its place in them, the edge that follows."""
    nxt, gap = _next(r)
    return W.mix(r.span ^ W.mix(nxt + gap.astype(U)))


def nodes_and_occurrences(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Repeated nodes with their contexts, and all occurrences of repeated nodes.

    nodes: g, ctx, n, place (one occurrence), to, gap, k (contexts of g);
    occurrences: g, ctx, doc_id, fp, at, lo, hi, place.
    """
    spark = texts.sparkSession

    def kmers(ids, fps, w, seq, r):
        return pa.RecordBatch.from_arrays([_i64(r.gram)], names=["g"])

    live = scratch.save(_run_pass(texts, kmers, "g bigint").groupBy("g").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"))
    maybe = spark.sparkContext.broadcast(bloom.build(live, "g", live.count()))

    def occurrences(ids, fps, w, seq, r):
        nxt, gap = _next(r)
        ctx = context(r)
        k = np.flatnonzero(bloom.hits(maybe.value, r.gram))
        d, o = r.doc[k], w.first[r.doc[k]]
        return pa.RecordBatch.from_arrays(
            [_i64(r.gram[k]), _i64(ctx[k]), _i64(nxt[k]), pa.array(gap[k]),
             pa.array(ids[d]), pa.array(fps[d]), pa.array(r.at[k] - o), pa.array(r.lo[k] - o),
             pa.array(r.hi[k] - o), _i64(_place(ids[d], fps[d], r.lo[k] - o))],
            names=["g", "ctx", "to", "gap", "doc_id", "fp", "at", "lo", "hi", "place"])

    occ = scratch.save(_run_pass(
        texts, occurrences, "g bigint, ctx bigint, to bigint, gap bigint, doc_id bigint, "
        "fp bigint, at bigint, lo bigint, hi bigint, place bigint").join(live, "g"))
    kinds = scratch.save(occ.groupBy("g", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("place"), F.max("to").alias("to"),
        F.max("gap").alias("gap")))
    per = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("k"))
    return scratch.save(kinds.join(per, "g")), occ


def compact_paths(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(g, path, dist): path = first node of g's nonbranching path, dist = words from it.

    Every round doubles the stretch that a node's pointer spans; it ends when
    all pointers stand at a path's first node.  There are no cycles: a walk
    along a cycle of nonbranching nodes could not reach its document's end.
    """
    plain = nodes.filter("k = 1").select("g", "to", "gap")
    # an edge compacts when both ends are nonbranching and it is the only one into its end
    into = (plain.filter("gap > 0").select(F.col("g").alias("back"), F.col("to").alias("g"),
                                           F.col("gap").alias("dist"))
            .join(plain.select("g"), "g").groupBy("g").agg(
                F.count(F.lit(1)).alias("n_in"), F.min("back").alias("back"),
                F.max("dist").alias("dist")))
    ptr = scratch.save(plain.select("g").join(into, "g", "left").select(
        "g", F.when(F.col("n_in") == 1, F.col("back")).otherwise(F.col("g")).alias("path"),
        F.when(F.col("n_in") == 1, F.col("dist")).otherwise(F.lit(0)).alias("dist")))
    while True:
        up = ptr.filter("path <> g").select(
            F.col("g").alias("u"), F.col("path").alias("up"), F.col("dist").alias("more"))
        step = scratch.save(ptr.join(up, F.col("path") == F.col("u"), "left").select(
            "g", F.coalesce("up", "path").alias("path"),
            (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"),
            F.col("up").isNotNull().alias("moved")))
        scratch.drop(ptr)
        ptr = step
        if not ptr.filter("moved").limit(1).count():
            return ptr.drop("moved")


def repeated_ranges(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, fp, start, end): word ranges whose WIDTH-word windows all occur elsewhere too."""
    spark = texts.sparkSession
    nodes, occ = nodes_and_occurrences(texts, scratch)
    paths = compact_paths(nodes, scratch)
    # a document's walk along a path: its nodes keep their distance from the path's start
    spans = (occ.join(paths, "g").groupBy("doc_id", "fp", "path",
                                          (F.col("at") - F.col("dist")).alias("origin"))
             .agg(F.min("lo").alias("start"), (F.max("hi") + WIDTH).alias("end"))
             .select("doc_id", "fp", "start", "end"))
    # branching nodes: whole contexts that repeat, then the windows of each context
    whole = occ.join(nodes.filter("k > 1 and n > 1").select("g", "ctx"), ["g", "ctx"]).select(
        "doc_id", "fp", F.col("lo").alias("start"), (F.col("hi") + WIDTH).alias("end"))
    mixed = nodes.groupBy("g").agg(F.max("k").alias("k"), F.min("n").alias("least")).filter(
        "k > 1 and least = 1").select("g")
    open_ = scratch.save(nodes.join(mixed, "g").select("place"))
    wanted = spark.sparkContext.broadcast(bloom.build(open_, "place", open_.count()))

    def windows(ids, fps, w, seq, r):
        o = w.first[r.doc]
        place = _place(ids[r.doc], fps[r.doc], r.lo - o)
        k = np.flatnonzero(bloom.hits(wanted.value, place))
        if not len(k):
            return None
        n = r.hi[k] - r.lo[k] + 1
        which = np.repeat(np.arange(len(k)), n)
        d = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        s = r.lo[k][which] + d
        return pa.RecordBatch.from_arrays(
            [_i64(seq.ranges(s, s + WIDTH)), _i64(place[k][which]), pa.array(d.astype(np.int16))],
            names=["w", "place", "d"])

    wins = scratch.save(_run_pass(texts, windows, "w bigint, place bigint, d smallint"))
    again = scratch.save(wins.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                         .select("w"))
    hit = wins.join(again, "w").groupBy("place").agg(F.collect_set("d").alias("ds"))
    # windows of one node: at most WIDTH - GRAM + 1 of them
    single = (occ.join(hit, "place").select("doc_id", "fp", "lo", F.explode("ds").alias("d"))
              .select("doc_id", "fp", (F.col("lo") + F.col("d")).alias("start"),
                      (F.col("lo") + F.col("d") + WIDTH).alias("end")))
    return spans.unionByName(whole).unionByName(single)


def cut_words(raw: bytes, ranges) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by one space) for [{start, end}, ...]."""
    words = raw.translate(_TO_SPACE).split(b" ") if raw else []
    words = [x for x in words if x]
    if not ranges:
        return len(words), 0, b" ".join(words)
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, [x["start"] for x in ranges], 1)
    np.add.at(mark, [x["end"] for x in ranges], -1)
    keep = np.cumsum(mark[:-1]) == 0
    kept = [x for x, k in zip(words, keep) if k]
    return len(words), len(words) - len(kept), b" ".join(kept)


_TO_SPACE = bytes(32 if W.IS_SPACE[i] else i for i in range(256))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept string), one row per row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "debruijn")
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
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string"

    def run(batches):
        for b in batches:
            out = [cut_words(t.as_py().encode() if t.is_valid else b"", r.as_py())
                   for t, r in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2].decode() for x in out], pa.string())],
                names=[x.split()[0] for x in schema.split(", ")])
    return some.unionByName(none).mapInArrow(run, schema)
