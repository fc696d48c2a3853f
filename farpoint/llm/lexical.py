"""Ranked lexical search over bit-sliced Bloom signatures, with exact rescoring.

The index holds one Bloom signature per document over its (term, tier) keys: a
term is entered in tier t if it occurs at least TIERS[t] times.  Documents with
about equally many keys form blocks; a block is stored by bit-slices (one row of
bits per signature position, one bit per document), so the documents that may
hold a term are the AND of a few slices.

1. One scan of the documents writes the index and counts, in the same tokens, how
   many documents hold each term of the queries.
2. In every block the tiers' bitmaps, weighted, are summed per query.  Slices
   never miss a term, and a tier bounds its frequency from above, so the sums
   are upper bounds of the scores.
3. The documents with the highest bounds are scored exactly; the K-th best of
   their scores is a threshold.  Every document whose bound reaches it is
   then scored exactly, the others are provably excluded.

The scores are integers (see ``term_weights`` and ``frequency_part``), so the
bounds are exact too.  A document is known by a 64-bit fingerprint of its
id and text; equal rows share one score.

Defined cases: null text, or a text without a term, is never found; a query
without terms (or with null text) finds nothing; equal scores are ordered by
doc_id, null last; repeated rows of documents each take a rank, repeated rows of
queries each give a result; empty tables give an empty result; further columns
are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from farpoint.llm import bloom
from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

TIERS = (1, 2, 4)            # least frequencies of a term that a tier stands for
HASHES = 4                   # bits that a key sets
MIN_BITS = 8                 # signature bits per key at least (twice that at most)
MAX_WIDTH = 1 << 18          # of a signature; a longer document fills it and is rescored
BLOCK_DOCS = 1024            # documents of a block at most
BLOCK_BITS = 1 << 24         # bits of a block at most
QUERY_BYTES = 1 << 20        # distinct query texts worked off together
CELLS = 1 << 21              # terms x documents whose bounds are held at once

# Fixed values of the score: weight scale, frequency scale, saturation and length parts.
WEIGHT_SCALE, PART_SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_PART = 1000, 10**9, 1000, 20, 50

#: letters and digits (A-Z lower-cased) and all bytes beyond ASCII make terms
TERM = np.arange(256, dtype=np.uint8)
TERM[[i for i in range(128) if not chr(i).isalnum()]] = 0x20
TERM[65:91] += 32


def term_words(c: W.Chunk) -> W.Words:
    """The terms of every document of a chunk."""
    return W.words(W.Chunk(c.lo, c.hi, TERM[c.buf], c.off))


def counted(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of the distinct terms, by document."""
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = np.lexsort((w.hash, w.doc))
    d, h = w.doc[order], w.hash[order]
    at = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])))
    return d[at], h[at], np.diff(np.append(at, len(d)))


def positions(h: np.ndarray, tier: int, width: int) -> list[np.ndarray]:
    """The signature positions of terms in a tier."""
    k = W.mix(h + np.uint64((2 * tier + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    a, b = k & np.uint64(0xFFFFFFFF), (k >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(width - 1)).astype(np.int64) for i in range(HASHES)]


def frequency_part(tf, m):
    """The score of a term's occurrences in a document of length part m, before its weight."""
    return PART_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m)


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * int(x) + 1)))
                     for x in df], np.int64)


# ---- the index --------------------------------------------------------------

INDEX = ("width int, slices binary, key array<bigint>, n array<bigint>, top array<bigint>, "
         "df array<bigint>, n_docs bigint, n_terms bigint")


class _Block:
    """Documents of one signature width that wait to be written."""

    def __init__(self, width: int):
        self.width, self.n_docs = width, 0
        self.bits: list[tuple[np.ndarray, np.ndarray]] = []
        self.meta: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def full(self) -> bool:
        return self.n_docs >= BLOCK_DOCS or self.n_docs * self.width >= BLOCK_BITS

    def row(self) -> pa.RecordBatch:
        m = np.zeros((self.width, self.n_docs), bool)
        for pos, doc in self.bits:
            m[pos, doc] = True
        key, n, top = (np.concatenate(x) for x in zip(*self.meta))
        return _row(self.width, np.packbits(m, axis=1).tobytes(), key, n, top)


def _row(width=None, slices=None, key=None, n=None, top=None, df=None, n_docs=None, n_terms=None):
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([width], pa.int32()), pa.array([slices], pa.binary()), pa.array([key], longs),
         pa.array([n], longs), pa.array([top], longs), pa.array([df], longs),
         pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())],
        names=["width", "slices", "key", "n", "top", "df", "n_docs", "n_terms"])


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): the key is a fingerprint of the row."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                    F.col("text").cast("string").alias("text"))
    return d.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def build_index(docs: DataFrame, vocabulary: np.ndarray, signatures: bool = True) -> DataFrame:
    """Blocks of signatures, and per task the counts of the (sorted) vocabulary's terms."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        v = vocab.value
        df, n_docs, n_terms = np.zeros(len(v), np.int64), 0, 0
        open_blocks: dict[int, _Block] = {}
        for b in batches:
            keys = np.asarray(b.column(0), dtype=np.int64)
            for c in W.chunks(b.column(1)):
                w = term_words(c)
                n = np.diff(w.first)
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + len(w.hash)
                d, h, tf = counted(w)
                if len(v):
                    at = np.minimum(np.searchsorted(v, h), len(v) - 1)
                    df += np.bincount(at[v[at] == h], minlength=len(v))
                if not signatures or not len(d):
                    continue
                n_keys = sum(np.bincount(d[tf >= t], minlength=c.n) for t in TIERS)
                top = np.zeros(c.n, np.int64)
                np.maximum.at(top, d, tf)
                width = 1 << np.ceil(np.log2(np.maximum(n_keys, 8) * MIN_BITS)).astype(np.int64)
                width = np.minimum(width, MAX_WIDTH)
                for x in np.unique(width[n > 0]):
                    mine = np.flatnonzero((width == x) & (n > 0))
                    most = max(1, min(BLOCK_DOCS, BLOCK_BITS // int(x)))
                    for part in np.split(mine, range(most, len(mine), most)):
                        block = open_blocks.setdefault(int(x), _Block(int(x)))
                        place = np.full(c.n, -1, np.int64)
                        place[part] = block.n_docs + np.arange(len(part))
                        for t, least in enumerate(TIERS):
                            on = (place[d] >= 0) & (tf >= least)
                            for pos in positions(h[on], t, int(x)):
                                block.bits.append((pos.astype(np.int32), place[d[on]].astype(np.int32)))
                        block.meta.append((keys[c.lo:c.hi][part], n[part], top[part]))
                        block.n_docs += len(part)
                        if block.full():
                            yield open_blocks.pop(int(x)).row()
        for block in open_blocks.values():
            yield block.row()
        yield _row(df=df, n_docs=n_docs, n_terms=n_terms)
    return keyed(docs).select("key", "text").mapInArrow(run, INDEX)


# ---- queries ----------------------------------------------------------------

@dataclass
class Queries:
    """A slice of the query texts: sorted vocabulary, and the terms of each query."""

    ids: list[int]
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Queries:
        doc, h = [], []
        for c in W.chunks(pa.array([t for _, t in rows], pa.large_string())):
            d, x, _ = counted(term_words(c))
            doc.append(d + c.lo), h.append(x)
        doc = np.concatenate(doc) if doc else np.zeros(0, np.int64)
        h = np.concatenate(h) if h else np.zeros(0, np.uint64)
        vocabulary, at = np.unique(h, return_inverse=True)
        cut = np.searchsorted(doc, np.arange(1, len(rows)))
        return cls([i for i, _ in rows], vocabulary, np.split(at, cut) if rows else [])

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length part m of documents with n terms."""
        return 100 - LENGTH_PART + LENGTH_PART * n * self.n_docs // self.n_terms


def block_bounds(q: Queries, width: int, slices: bytes, n: np.ndarray, top: np.ndarray):
    """Per part of the block's documents: (first document, upper bounds [query, document])."""
    rows = np.frombuffer(slices, np.uint8).reshape(width, -1)
    pos = [positions(q.vocabulary, t, width) for t in range(len(TIERS))]
    step = max(8, CELLS // max(1, len(q.vocabulary)) // 8 * 8)
    for lo in range(0, len(n), step):
        hi = min(lo + step, len(n))
        m = q.lengths(n[lo:hi])
        part = np.zeros((len(q.vocabulary), hi - lo))
        both, below = None, np.zeros(hi - lo, np.int64)
        for t in range(len(TIERS)):
            for p in pos[t]:
                bits = rows[p, lo // 8:(hi + 7) // 8]
                both = bits.copy() if both is None else both & bits
            most = TIERS[t + 1] - 1 if t + 1 < len(TIERS) else top[lo:hi]
            upto = frequency_part(np.maximum(np.minimum(most, top[lo:hi]), 1), m)
            part += np.unpackbits(both, axis=1)[:, :hi - lo] * (upto - below).astype(float)
            below = upto
        # integers below 2^53: float sums are exact
        yield lo, np.stack([q.weights[x].astype(float) @ part[x] for x in q.terms])


def _found(q: Queries, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    query = np.repeat([x for x, _, _ in rows], [len(k) for _, k, _ in rows]).astype(np.int32)
    key = np.concatenate([k for _, k, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
    ub = np.concatenate([u for _, _, u in rows] or [np.zeros(0)]).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(key), pa.array(ub)],
                                      names=["query", "key", "bound"])


def highest_bounds(index: DataFrame, q: Queries, k: int) -> DataFrame:
    """(query, key, bound): at least the k documents with the highest bounds of each query."""
    shared = index.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        q = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q.terms]
        for width, slices, key, n, top in _blocks(batches):
            for lo, ub in block_bounds(q, width, slices, n, top):
                for i, u in enumerate(ub):
                    keys, old = best[i]
                    least = old.min() if len(old) >= k else 0
                    on = np.flatnonzero(u > least)
                    if len(on):
                        keys, old = np.append(keys, key[lo + on]), np.append(old, u[on])
                        if len(old) > k:
                            take = np.argpartition(-old, k - 1)[:k]
                            keys, old = keys[take], old[take]
                        best[i] = keys, old
        yield _found(q, [(i, a, b) for i, (a, b) in enumerate(best)])
    rows = index.filter("slices is not null").select("width", "slices", "key", "n", "top").mapInArrow(
        run, "query int, key bigint, bound bigint")
    w = Win.partitionBy("query").orderBy(F.desc("bound"), "key")
    return rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")


def reaching(index: DataFrame, q: Queries, least: np.ndarray) -> DataFrame:
    """(query, key, bound): every document whose bound is positive and reaches the threshold."""
    shared = index.sparkSession.sparkContext.broadcast((q, least))

    def run(batches):
        q, least = shared.value
        for width, slices, key, n, top in _blocks(batches):
            for lo, ub in block_bounds(q, width, slices, n, top):
                at = [np.flatnonzero((u > 0) & (u >= t)) for u, t in zip(ub, least)]
                yield _found(q, [(i, key[lo + x], ub[i][x]) for i, x in enumerate(at)])
    return index.filter("slices is not null").select("width", "slices", "key", "n", "top").mapInArrow(
        run, "query int, key bigint, bound bigint")


def _blocks(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield (b.column(0)[i].as_py(), b.column(1)[i].as_buffer(),
                   *(np.asarray(b.column(j)[i].values, dtype=np.int64) for j in (2, 3, 4)))


# ---- exact scores -----------------------------------------------------------

def term_frequencies(rows: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(key, doc_id, n, term, tf): the vocabulary's terms in every row of (key, doc_id, text)."""
    vocab = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "key bigint, doc_id bigint, n bigint, term array<int>, tf array<bigint>"

    def run(batches):
        v = vocab.value
        for b in batches:
            for c in W.chunks(b.column(2)):
                w = term_words(c)
                d, h, tf = counted(w)
                at = np.minimum(np.searchsorted(v, h), len(v) - 1)
                on = v[at] == h
                cut = pa.array(np.searchsorted(d[on], np.arange(c.n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.lo, c.n), b.column(1).slice(c.lo, c.n),
                     pa.array(np.diff(w.first).astype(np.int64)),
                     pa.ListArray.from_arrays(cut, pa.array(at[on].astype(np.int32))),
                     pa.ListArray.from_arrays(cut, pa.array(tf[on].astype(np.int64)))],
                    names=["key", "doc_id", "n", "term", "tf"])
    return rows.mapInArrow(run, schema)


def exact_scores(pairs: DataFrame, rows: DataFrame, q: Queries) -> DataFrame:
    """(query, key, doc_id, score, copies) of the candidate (query, key) rows with a score."""
    shared = pairs.sparkSession.sparkContext.broadcast(q)
    copies = pairs.groupBy("query", "key").agg(F.count(F.lit(1)).alias("copies"))
    tfs = term_frequencies(rows, q.vocabulary).dropDuplicates(["key"])
    joined = copies.join(tfs, "key").select("query", "key", "doc_id", "copies", "n", "term", "tf")

    def run(batches):
        q = shared.value
        size = len(q.vocabulary)
        codes = np.sort(np.concatenate([i * size + x for i, x in enumerate(q.terms)]))
        for b in batches:
            query = np.asarray(b.column(0), dtype=np.int64)
            term, tf = b.column(5), b.column(6)
            row = np.repeat(np.arange(b.num_rows), np.asarray(term.value_lengths(), dtype=np.int64))
            x, f = np.asarray(term.flatten(), np.int64), np.asarray(tf.flatten(), np.int64)
            code = query[row] * size + x
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            m = q.lengths(np.asarray(b.column(4), dtype=np.int64))
            gain = np.where(codes[at] == code, q.weights[x] * frequency_part(f, m[row]), 0)
            total = np.append(0, np.cumsum(gain))
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            score = pa.array(total[cut[1:]] - total[cut[:-1]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), score, b.column(3)],
                names=["query", "key", "doc_id", "score", "copies"])
    return joined.mapInArrow(
        run, "query int, key bigint, doc_id bigint, score bigint, copies bigint").filter("score > 0")


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """(query, rank, doc_id, score): the k best rows of each query."""
    each = scored.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    w = Win.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "key", "copy")
    return (each.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    asked = scratch.save(items.select("item_id", F.col("text").cast("string").alias("text"))
                         .filter(F.col("text").isNotNull())
                         .withColumn("query_id", F.xxhash64("text")))
    texts = asked.select("query_id", "text").dropDuplicates(["query_id"])
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = -(-int(n_bytes) // QUERY_BYTES)
    rows = keyed(docs)
    found, index = [], None
    for i in range(n_slices):
        mine = texts.filter(F.pmod(F.xxhash64("query_id"), F.lit(n_slices)) == i).orderBy("query_id")
        q = Queries.of([(r["query_id"], r["text"]) for r in mine.collect()])
        if not len(q.vocabulary):
            continue
        built = scratch.save(build_index(docs, q.vocabulary, signatures=index is None))
        index = index or built
        got = built.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        q.n_docs, q.n_terms = int(got[0] or 0), int(got[1] or 0)
        if not q.n_terms:
            break
        df = (built.filter("df is not null").select(F.posexplode("df").alias("t", "n"))
              .groupBy("t").agg(F.sum("n").alias("n")).collect())
        count = np.zeros(len(q.vocabulary), np.int64)
        for r in df:
            count[r["t"]] = r["n"]
        q.weights = term_weights(q.n_docs, count)
        # k rows a query: bounded by the slice
        seeds = scratch.save(highest_bounds(index, q, k))
        near = rows.join(F.broadcast(seeds.select("key").distinct()), "key").select("key", "doc_id", "text")
        first = exact_scores(seeds, near, q).withColumn(
            "copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
        w = Win.partitionBy("query").orderBy(F.desc("score"), "key", "copy")
        kth = first.withColumn("r", F.row_number().over(w)).filter(F.col("r") == k).collect()
        least = np.zeros(len(q.terms))
        for r in kth:
            least[r["query"]] = r["score"]
        pairs = scratch.save(reaching(index, q, least))
        keys = pairs.select("key").distinct()
        maybe, _ = bloom.split(rows, F.xxhash64("key"), bloom.build(
            keys.select(F.xxhash64("key").alias("h")), "h", keys.count()))
        best = ranked(exact_scores(pairs, maybe.select("key", "doc_id", "text"), q), k)
        ids = spark.createDataFrame(list(enumerate(q.ids)), "query int, query_id bigint")
        found.append(scratch.save(best.join(F.broadcast(ids), "query").drop("query")))
        scratch.drop(seeds, pairs)
    if not found:
        return asked.limit(0).select("item_id", F.lit(1).alias("rank"), F.lit(1).cast("bigint").alias(
            "doc_id"), F.lit(1).cast("bigint").alias("score"))
    all_found = found[0]
    for x in found[1:]:
        all_found = all_found.unionByName(x)
    return all_found.join(asked.select("item_id", "query_id"), "query_id").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
